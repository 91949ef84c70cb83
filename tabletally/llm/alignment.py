"""Cross-tokenizer alignment with an identity-map fast path.

Two tokenizers cut the same bytes. Offsets where tokens of both end cut them
into *groups*; tokens of both that overlap are *links*. Between two neighbouring
ends of either side lies exactly one link, so links are found from the merged
ends, without looking at pairs.

Most groups hold one token of each side with the same bytes. The map from an
A id to the B id with the same bytes is known beforehand, so the links of such
groups need no pair: how many documents hold them is counted in vectors as long
as A's vocabulary. Only the pairs of irregular groups enter the shuffle, once
per task with their number of documents.

Both tokenizers end a token before a space that follows a non-space, whatever
stands around it, so such places cut a text into *pieces* that are tokenized,
grouped and linked each for itself. A task keeps what it found for short pieces
(most are words) and works out only those it has not met.

Tokens are made once. What a document links (its distinct pairs with their
numbers of occurrences, compressed) is kept in the shared folder, and the
corpus-wide counts are read back against it: those of the identity map and of
``frequent`` pairs from arrays of bounded length, those of all rarer pairs by a
join, in which no pair is held by more documents than the least frequent one
of the arrays.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols
from .common import free_name, reliable, table

CHARS_AT_ONCE = 1 << 20
#: Pieces a task remembers, and the longest that it does.
MOST_PIECES, LONGEST = 1 << 19, 64
#: Links of remembered and of passing pieces after which a task starts anew.
MOST_LINKS = 1 << 22
#: A space with what follows it up to the next space after a non-space. Python's white space holds all of the
#: tokenizers' white space, so no cut is made inside a run of theirs.
PIECE = re.compile(r" \s*(?:\S+(?:[^\S ]\s*)?)*")
PIECES_IN_LINE = 32
PAIRS_AT_ONCE = 1 << 21
#: Pairs whose counts are sent to every task, the most frequent ones: 16 bytes each.
FREQUENT = 1 << 18
#: The pattern's look-ahead recurses over white space; texts with such runs go through the other library.
LONG_GAP = re.compile(r"\s{2000}")


class Tokenizers:
    """Both tokenizers, made in a task from their files' contents, and the bytes of every token."""

    def __init__(self, byte_bpe: str, piece_bpe: bytes):
        self.spec, spec = byte_bpe, json.loads(byte_bpe)
        byte_of = {c: b for b, c in byte_symbols().items()}
        a = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if set(token) <= byte_of.keys()}
        specials = {t["id"] for t in spec["added_tokens"]}
        ranks = {token: i for token, i in a.items() if i not in specials}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        self.bytes_a = [b""] * (max(a.values()) + 1)
        for token, i in a.items():
            self.bytes_a[i] = token
        self.bytes_b = [self.piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        self.lengths_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # a byte and a piece may have the same bytes; the piece, which comes later, is the usual token
        same = {t: i for i, t in enumerate(self.bytes_b)}
        self.identity = np.array([same.get(t, -1) if t else -1 for t in self.bytes_a], np.int64)

    @staticmethod
    def piece_bytes(piece: str) -> bytes:
        """Fixed format: <0xHH> is a byte, U+2581 a space."""
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    @cached_property
    def slow_a(self) -> tokenizers.Tokenizer:
        slow = tokenizers.Tokenizer.from_str(self.spec)
        slow.encode_special_tokens = True
        return slow

    def tokens_a(self, text: str) -> list[int]:
        if len(text) >= 2000 and LONG_GAP.search(text):
            return self.slow_a.encode(text, add_special_tokens=False).ids
        return self.a.encode_ordinary(text)

    @cached_property
    def cuts_at_spaces(self) -> bool:
        """True if no piece of B goes on after a space that follows something else."""
        return not any(b" " in t.lstrip(b" ") for t in self.bytes_b)

    def pieces(self, text: str) -> list[str]:
        """The pieces of a space and the text, without the space each begins with; none for an empty text."""
        if not text:
            return []
        if not self.cuts_at_spaces:
            return [text]
        return [p[1:] for p in PIECE.findall(" " + text)]

    def one(self, text: str) -> tuple[list[int], list[int]] | None:
        """Token ids of both sides for a space and the text; None where a side's bytes are not those."""
        whole = " " + text
        a, b, expected = self.tokens_a(whole), self.b.encode(text) if text else [self.b.piece_to_id("▁")], whole.encode()
        same = b"".join(map(self.bytes_a.__getitem__, a)) == expected == b"".join(map(self.bytes_b.__getitem__, b))
        return (a, b) if same else None

    def many(self, texts: list[str]) -> tuple[np.ndarray, ...] | None:
        """Ids of both sides for all pieces, tokenized as one text, and the number of tokens of each piece.

        None if the bytes or the pieces' ends are not those of the tokens: then each stands for itself.
        """
        whole = " " + " ".join(texts)
        expected, a = whole.encode(), self.a.encode_ordinary(whole)
        # B's queue of merges is the slower the longer the text
        lines = [" ".join(texts[i : i + PIECES_IN_LINE]) for i in range(0, len(texts), PIECES_IN_LINE)]
        b = list(chain.from_iterable(self.b.encode(lines)))
        if not b"".join(map(self.bytes_a.__getitem__, a)) == expected == b"".join(map(self.bytes_b.__getitem__, b)):
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends = np.cumsum([len(t.encode()) + 1 for t in texts])
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        to_a, to_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        if not ((ends_a[to_a] == ends).all() and (ends_b[to_b] == ends).all()):
            return None
        return a, b, np.diff(to_a + 1, prepend=0), np.diff(to_b + 1, prepend=0)


class Numerals:
    """Decimal texts of many ids at once."""

    def __init__(self, most: int):
        self.width = len(str(most))
        text = np.array([str(i).ljust(self.width) for i in range(most + 1)], f"S{self.width}")
        self.digits = text.view(np.uint8).reshape(most + 1, self.width)
        self.lengths = np.array([len(str(i)) for i in range(most + 1)], np.int8)

    def joined(self, ids: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids, each followed by the character ``after`` (0: none), and the length of each with it."""
        lengths = self.lengths[ids]
        cells = np.empty((len(ids), self.width + 1), np.uint8)
        cells[:, :-1] = self.digits[ids]
        cells[np.arange(len(ids)), lengths] = after
        sizes = lengths + (after > 0)
        return cells[np.arange(self.width + 1) < sizes[:, None]].tobytes(), sizes.astype(np.int64)


class Alignment:
    """Groups and links of a batch of pieces, with array operations over all its tokens."""

    def __init__(self, both: Tokenizers, texts: list[str], together: bool = False):
        found = both.many(texts) if together else None
        if found:
            self.a, self.b, self.n_a, self.n_b = found
            self.whole = np.ones(len(texts), bool)
        else:
            each = [both.one(t) for t in texts]
            self.whole = np.array([t is not None for t in each], bool)
            tokens = [t or ([], []) for t in each]
            self.n_a = np.array([len(a) for a, _ in tokens], np.int64)
            self.n_b = np.array([len(b) for _, b in tokens], np.int64)
            self.a = np.concatenate([np.array(a, np.int64) for a, _ in tokens])
            self.b = np.concatenate([np.array(b, np.int64) for _, b in tokens])
        self.ends_a, self.ends_b = np.cumsum(both.lengths_a[self.a]), np.cumsum(both.lengths_b[self.b])
        ends = np.concatenate([[0], self.ends_a])[np.cumsum(self.n_a)]
        self.text_ends = ends
        # both sides have the same bytes, so a piece's end is an end of both
        at = np.searchsorted(self.ends_b, self.ends_a)
        common = self.ends_b[at] == self.ends_a if len(at) else np.zeros(0, bool)
        self.last_a, self.last_b = np.flatnonzero(common), at[common]  # the last tokens of each group
        self.n_groups = np.diff(np.searchsorted(self.ends_a[self.last_a], ends, "right"), prepend=0)

    def group_texts(self, numerals: Numerals) -> Iterator[bytes]:
        """Each piece's groups: A ids and B ids with commas, a bar between them, a semicolon after each group but the last."""
        n_a, n_b = len(self.a), len(self.b)
        of_a = np.searchsorted(self.last_a, np.arange(n_a))
        of_b = np.searchsorted(self.last_b, np.arange(n_b))
        place_a = np.arange(n_a) + np.concatenate([[0], self.last_b + 1])[of_a]
        place_b = np.arange(n_b) + (self.last_a + 1)[of_b]
        ids, after = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        after[place_a[self.last_a]], after[place_b[self.last_b]] = ord("|"), ord(";")
        counts = self.n_a + self.n_b
        last = np.cumsum(counts) - 1
        after[last[counts > 0]] = 0
        text, sizes = numerals.joined(ids, after)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], last + 1])]
        for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            yield text[start:end]

    def links(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(piece, a * width + b, occurrences) of each piece's distinct links, ordered."""
        ends = np.sort(np.concatenate([self.ends_a, self.ends_b]), kind="stable")  # merges two ordered runs
        ends = ends[np.diff(ends, prepend=0) > 0]  # no token is empty
        a = self.a[np.searchsorted(self.ends_a, ends)]
        b = self.b[np.searchsorted(self.ends_b, ends)]
        return totals(np.searchsorted(self.text_ends, ends), a * width + b, np.ones(len(ends), np.int64))


def totals(of: np.ndarray, codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``times`` added up by (of, code), in their order."""
    if not len(of):
        return of, codes, times
    shift = int(codes.max()).bit_length()
    if shift + int(of.max()).bit_length() < 63:
        keys = of << shift | codes
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first] >> shift, keys[first] & ((1 << shift) - 1), np.add.reduceat(times[order], first)
    order = np.lexsort([codes, of])
    of, codes = of[order], codes[order]
    first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (codes[1:] != codes[:-1])]))
    return of[first], codes[first], np.add.reduceat(times[order], first)


class Pieces:
    """What a task has found of the pieces it met: numbers, group texts and links, by the piece's place."""

    def __init__(self, both: Tokenizers):
        self.both, self.width = both, len(both.bytes_b)
        self.numerals = Numerals(max(len(both.bytes_a), self.width))
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.numbers = np.zeros((4, 0), np.int64)  # whole, n_a, n_b, n_groups
        self.starts, self.codes, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, texts: list[str], together: bool) -> None:
        found = Alignment(self.both, texts, together)
        of, codes, times = found.links(self.width)
        ends = len(self.codes) + np.searchsorted(of, np.arange(1, len(texts) + 1))
        self.place.update(zip(texts, range(len(self.groups), len(self.groups) + len(texts)), strict=True))
        self.groups += found.group_texts(self.numerals)
        numbers = np.stack([found.whole.astype(np.int64), found.n_a, found.n_b, found.n_groups])
        self.numbers = np.concatenate([self.numbers, numbers], axis=1)
        self.starts = np.concatenate([self.starts, ends])
        self.codes, self.times = np.concatenate([self.codes, codes]), np.concatenate([self.times, times])

    def texts(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: (n_a, n_b, n_groups), its groups; and the ordered links (text, code, occurrences) of all."""
        pieces = [self.both.pieces(t) for t in texts]
        of = np.repeat(np.arange(len(texts)), [len(p) for p in pieces])
        flat = list(chain.from_iterable(pieces))
        at = np.fromiter(map(self.place.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(at < 0)
        unknown = [flat[i] for i in missing.tolist()]
        new = set(unknown)
        # a piece that ends in a non-space ends where the next one's space begins, in any order
        plain = sorted(p for p in new if p and not p[-1].isspace() and "▁" not in p and not LONG_GAP.search(p))
        if plain:
            self.learn(plain, together=True)
        if len(plain) < len(new):
            self.learn(sorted(new.difference(plain)), together=False)
        at[missing] = list(map(self.place.__getitem__, unknown))
        broken = np.zeros(len(texts), bool)
        broken[of[self.numbers[0, at] == 0]] = True
        fine = ~broken[of]
        of, at = of[fine], at[fine]
        cuts = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
        named = list(map(self.groups.__getitem__, at.tolist()))
        groups = [b";".join(named[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        numbers = np.stack([np.bincount(of, values[at], len(texts)).astype(np.int64) for values in self.numbers[1:]])
        # a text's pieces with their occurrences, then the links of those
        of, at, times = totals(of, at, np.ones(len(at), np.int64))
        sizes = self.starts[at + 1] - self.starts[at]
        link = np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        links = totals(np.repeat(of, sizes), self.codes[link], self.times[link] * np.repeat(times, sizes))
        for p in new:
            if len(p) > LONGEST:
                del self.place[p]
        if len(self.place) > MOST_PIECES or len(self.codes) > MOST_LINKS:
            self.forget()
        return numbers, groups, *links


def packed(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending codes as differences and their occurrences, byte by byte side by side, compressed."""
    if not len(codes):
        return b""
    both = np.concatenate([np.diff(codes, prepend=0), times]).astype("<i8")
    planes = np.ascontiguousarray(both.view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes[: 1 + int(np.flatnonzero(planes.any(axis=1))[-1])].tobytes(), 1) + len(codes).to_bytes(4, "little")


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = int.from_bytes(data[-4:], "little")
    planes = np.frombuffer(zstandard.decompress(data[:-4]), np.uint8).reshape(-1, 2 * n)
    both = np.zeros((2 * n, 8), np.uint8)
    both[:, : len(planes)] = planes.T
    values = both.view("<i8").ravel()
    return np.cumsum(values[:n]), values[n:]


def text_parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about CHARS_AT_ONCE characters; a longer text stands alone."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy())
    start = 0
    while start < batch.num_rows:
        before = int(sizes[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + CHARS_AT_ONCE, "right")))
        yield batch.slice(start, end - start)
        start = end


def made(files: Broadcast) -> Tokenizers:
    return Tokenizers(*files.value)


def aligned(df: DataFrame, text: str, files: Broadcast, digest: bool, keep: list[str]) -> DataFrame:
    """``keep`` and n_a, n_b, n_groups, n_links, groups (or their sha256), links (packed), a row per row of ``df``."""
    kept = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(free_name(df, "_text")))
    place = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Pieces(made(files))
        for batch in batches:
            for part in text_parts(batch, place):
                (n_a, n_b, n_groups), groups, of, codes, times = known.texts([t or "" for t in part.column(place).to_pylist()])
                cuts = np.searchsorted(of, np.arange(part.num_rows + 1))
                if digest:
                    groups = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                else:
                    groups = [g.decode() for g in groups]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:place], *map(pa.array, (n_a, n_b, n_groups, n_a + n_b - n_groups)),
                     pa.array(groups, pa.string()),
                     pa.array([packed(codes[i:j], times[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                    names=[*keep, "n_a", "n_b", "n_groups", "n_links", "groups", "links"],
                )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:place]]
    return kept.mapInArrow(run, ", ".join([*kinds, "n_a long, n_b long, n_groups long, n_links long, groups string, links binary"]))


def link_counts(docs: DataFrame, identity_map: Broadcast) -> DataFrame:
    """(code, n): how many rows of ``docs`` hold each pair linked, over all rows.

    A task counts the pairs of the identity map in one vector and the others in
    sorted runs of bounded length, which Spark adds up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, identity = identity_map.value
        usual = np.zeros(len(identity), np.int64)
        held: list[np.ndarray] = []
        size = 0

        def run() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

        for batch in batches:
            for data in batch.column(0).to_pylist():
                codes, _ = unpacked(data)
                a = codes // width
                same = identity[a] == codes - a * width
                usual[a[same]] += 1  # a document's pairs are distinct
                held.append(codes[~same])
                size += len(held[-1])
                if size >= PAIRS_AT_ONCE:
                    yield run()
                    size = 0
        if held:
            yield run()
        a = np.flatnonzero(usual)
        yield pa.RecordBatch.from_arrays([pa.array(a * width + identity[a]), pa.array(usual[a])], names=["code", "n"])

    partial = docs.select("links").mapInArrow(count, "code long, n long")
    return partial.groupBy("code").agg(F.sum("n").alias("n"))


def open_files(spark, byte_bpe: str | None, piece_bpe: str | None) -> Broadcast:
    """The contents of both vocabulary files, a few MB, for the tasks."""
    with open(byte_bpe or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        a = f.read()
    with open(piece_bpe or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return spark.sparkContext.broadcast((a, f.read()))


def align(
    df: DataFrame, key: str = "doc_id", text: str = "text", byte_bpe: str | None = None, piece_bpe: str | None = None,
    digest: bool = False, frequent: int = FREQUENT,
) -> DataFrame:
    """One row per row of ``df``: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``groups`` is the alignment itself, ``a1,a2|b1;a3|b2,b3`` in decimal ids,
    or its lowercase sha256 with ``digest``. A pair's count is the number of
    rows that hold it linked; ``count_sum`` adds the counts of a row's links up
    and ``n_best`` counts the links that have the highest count of their A id.
    Defaults of the two files are the public tokenizers'.

    Defined cases: null and empty texts, and texts that a side does not give
    back byte by byte with a space before them, have no tokens (zeros, an empty
    ``groups``); special tokens' strings are plain text; equal rows count once
    each; null keys are kept; long texts are read whole; an empty table gives no
    rows; other columns are not used.
    """
    spark = df.sparkSession
    files = open_files(spark, byte_bpe, piece_bpe)
    both = made(files)
    width, identity = len(both.bytes_b), both.identity
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_whole"), F.monotonically_increasing_id().alias("row"))
    docs = reliable(aligned(rows, "_whole", files, digest, ["_key", "row"]))
    of_a = F.floor(F.col("code") / F.lit(width))
    counts = reliable(link_counts(docs, spark.sparkContext.broadcast((width, identity))).withColumn("a", of_a))
    # bounded by A's vocabulary: the highest count of each A id, and the counts of the identity map
    highest = np.zeros(len(identity), np.int64)
    for r in counts.groupBy("a").agg(F.max("n").alias("n")).collect():
        highest[r["a"]] = r["n"]
    mapped = np.flatnonzero(identity >= 0)
    pairs = spark.createDataFrame(pa.table({"code": mapped * width + identity[mapped]}))
    usual = np.zeros(len(identity), np.int64)
    for r in counts.join(F.broadcast(pairs), "code", "left_semi").collect():
        usual[r["a"]] = r["n"]
    others = counts.join(F.broadcast(pairs), "code", "left_anti")
    known = others.orderBy(F.desc("n"), "code").limit(frequent).collect()
    known_codes = np.sort(np.array([r["code"] for r in known], np.int64))
    known_n = np.array([r["n"] for r in sorted(known, key=lambda r: r["code"])], np.int64)
    sent = spark.sparkContext.broadcast((identity, highest, usual, known_codes, known_n))

    def split(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A row's pairs: codes, occurrences, and the count where the arrays have it (else 0), A ids."""
        identity, _, usual, known_codes, known_n = sent.value
        codes, times = unpacked(data)
        a = codes // width
        n = np.where(identity[a] == codes - a * width, usual[a], 0)
        if len(known_codes):
            at = np.minimum(np.searchsorted(known_codes, codes), len(known_codes) - 1)
            n = np.where(known_codes[at] == codes, known_n[at], n)
        return codes, times, n, a

    def rarer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = batch.column(0).to_numpy(), []
            for i, data in enumerate(batch.column(1).to_pylist()):
                codes, times, n, _ = split(data)
                rest = n == 0
                out.append((np.full(int(rest.sum()), row[i]), codes[rest], times[rest]))
            if out:
                columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "code", "times"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        highest = sent.value[1]
        for batch in batches:
            best, total = [], []
            for data in batch.column(batch.num_columns - 1).to_pylist():
                _, times, n, a = split(data)
                best.append(int(times[(n > 0) & (n == highest[a])].sum()))
                total.append(int((times * n).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(best, pa.int64()), pa.array(total, pa.int64())],
                names=[*batch.schema.names[:-1], "best", "total"],
            )

    # what the arrays lack: (row, pair) joined with the pair's count
    top = spark.createDataFrame(pa.table({"a": np.arange(len(highest)), "top": highest}))
    asked = docs.select("row", "links").mapInArrow(rarer, "row long, code long, times long")
    answers = (
        asked.join(others.join(F.broadcast(top), "a").select("code", "n", (F.col("n") == F.col("top")).alias("is_best")), "code")
        .groupBy("row").agg(
            F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_total"),
        )
    )
    columns = ["_key", "row", "n_a", "n_b", "n_groups", "n_links", "groups"]
    kind = docs.schema["_key"].dataType.simpleString()
    schema = f"_key {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups string, best long, total long"
    sums = docs.select(*columns, "links").mapInArrow(summed, schema)
    return sums.join(answers, "row", "left").select(
        F.col("_key").alias(key), "n_a", "n_b", "n_groups", "n_links",
        (F.col("best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("more_total", F.lit(0))).alias("count_sum"),
        "groups",
    )


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    """Every document's alignment of the two public tokenizers, as digests."""
    return align(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")
