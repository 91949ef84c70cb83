"""Counts of one text that the quality operators build on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from .common import with_text_columns

#: ASCII white space, and the symbols that mark tables and markup.
SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = bytes(range(ord("0"), ord("9") + 1))
POINTS = b"!\"'()+,-./:;=?@[\\]^_`{}~"

NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_top_word", "n_upper", "n_digits", "n_points", "n_exclaim", "n_other", "n_twice",
)


def count_of(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def ngram_ids(ids: np.ndarray, n: int, kinds: int) -> np.ndarray:
    """One number per window of ``n`` ids, equal for equal windows; ids are below ``kinds``."""
    out = ids[: len(ids) - n + 1].astype(np.int64)
    for k in range(1, n):
        if out.size and int(out.max()) >= 2**62 // max(kinds, 1):
            out = np.unique(out, return_inverse=True)[1]
        out = out * kinds + ids[k : len(ids) - n + 1 + k]
    return out


def counts(text: str) -> tuple[int, ...]:
    """The counts named in ``NAMES``. Words are runs without ASCII white space; lines are cut at \\n.

    n_dup_lines   lines with a word that equal an earlier line
    n_repeat_words  words in 3-word windows found twice or more, the first included
    n_top_word    occurrences of the most frequent word
    n_other       extra UTF-8 bytes of non-ASCII characters
    n_twice       words equal to the word before
    """
    raw = text.encode()
    words = raw.split()  # bytes.split() cuts at exactly the ASCII white space
    n = len(words)
    seen: set[bytes] = set()
    lines = dup_lines = 0
    for line in raw.split(b"\n"):
        if line.strip(SPACE):
            lines += 1
            if line in seen:
                dup_lines += 1
            seen.add(line)
    number: dict[bytes, int] = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, n)
    repeated = 0
    if n > 3:
        grams = ngram_ids(ids, 3, len(number))
        _, where, many = np.unique(grams, return_inverse=True, return_counts=True)
        again = many[where] > 1
        if again.any():
            inside = np.zeros(n, bool)
            for k in range(3):
                inside[k : n - 2 + k] |= again
            repeated = int(inside.sum())
    return (
        n, len(text) - count_of(raw, SPACE), count_of(raw, SYMBOLS), dup_lines, repeated,
        lines, len(number), int(np.bincount(ids).max()) if n else 0,
        count_of(raw, UPPER), count_of(raw, DIGITS), count_of(raw, POINTS), raw.count(b"!"),
        len(raw) - len(text),
        int((ids[1:] == ids[:-1]).sum()) if n > 1 else 0,
    )


def with_counts(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``df`` and the counts of each text (null: empty)."""

    def make():
        return lambda texts: [list(column) for column in zip(*map(counts, texts), strict=True)]

    return with_text_columns(df, text, StructType([StructField(n, LongType()) for n in NAMES]), make, keep)
