"""BPE encoding and decoding by prefix-sharing trie traversal.

The tokenizer is a "BPE with word ends" file of the tokenizers library: texts
are NFC-normalised and lower-cased, cut into words, and each word is merged by
rank; the last symbol of a word carries ``</w>``.

Why a trie works. A token sequence is the BPE encoding of its text exactly if
every neighbouring pair of tokens is: merging the symbols of the two by rank
gives the two back. So the encoding of a prefix is known by its *last token*
alone: among the tokens that end the prefix, it is the one that fits the last
token of the shorter prefix before it. That state depends on the prefix only.
The distinct words of a block go into a trie; one depth-first walk carries the
last-token states down, so a prefix that many words share is encoded once. At a word's end the same rule picks the closing ``</w>`` token,
and the chain of states read backwards is the encoding.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from .common import table, with_text_columns

#: The public tokenizer's file, unless a caller names another.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Fitting and unfitting pairs that a worker remembers.
PAIRS_KEPT = 1 << 20
END = "</w>"
#: Fixed value: the file's word pattern.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Encodes words of one tokenizer file; holds the vocabulary and the memo of fitting pairs."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model.get("end_of_word_suffix") != END or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != WORDS:
            raise ValueError("not a BPE file with word ends as this module reads it")
        self.ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.ids.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.specials.items()}
        self.ranks = {tuple(pair): r for r, pair in enumerate(model["merges"])}
        self.made = {a + b: (a, b, r) for (a, b), r in self.ranks.items()}
        self.symbols = byte_symbols()
        self.fits: dict[int, bool] = {}
        self.edges: dict[tuple[int, bool], list[tuple[str, int]]] = {}
        whole = {t: i for t, i in self.ids.items() if self.merge(self.split(t)) == [t]}
        self.inner = suffix_trie({t: i for t, i in whole.items() if not t.endswith(END)})
        self.closing = suffix_trie({t[: -len(END)]: i for t, i in whole.items() if t.endswith(END)})

    @classmethod
    def of(cls, state: dict) -> WordEncoder:
        """An encoder from the plain tables of another one; the memo tables of ``state`` are used and filled."""
        encoder = cls.__new__(cls)
        encoder.__dict__ = state
        if len(encoder.fits) > PAIRS_KEPT:
            encoder.fits.clear()
        return encoder

    def split(self, token: str) -> list[str]:
        if token.endswith(END):
            return [*token[: -len(END) - 1], token[-len(END) - 1 :]]
        return list(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain rank-order merging; used on the vocabulary itself only."""
        ranks = self.ranks
        while len(symbols) > 1:
            best, at = min((ranks.get((a, b), len(ranks)), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)))
            if best == len(ranks):
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def edge(self, token: int, right: bool) -> list[tuple[str, int]]:
        """The pieces that stand at the token's right (left) end while it is merged, from a
        single symbol to the whole, each with the rank of the merge that uses it up."""
        if (known := self.edges.get((token, right))) is None:
            piece, until = self.tokens[token], len(self.ranks)
            known = [(piece, until)]
            while piece in self.made:
                a, b, until = self.made[piece]
                piece = b if right else a
                known.append((piece, until))
            known = self.edges[token, right] = known[::-1]
        return known

    def fit(self, a: int, b: int) -> bool:
        """Whether two tokens stay as they are side by side: no merge across their border
        comes before the merges that use up the pieces at the border."""
        left, right, ranks = self.edge(a, True), self.edge(b, False), self.ranks
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            rank = ranks.get((x, y), len(ranks))
            # of equal merges the one further left comes first
            if rank < x_until and rank <= y_until and rank < len(ranks):
                return False
            if i == len(left) - 1 and j == len(right) - 1:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def last_token(self, path: str, at: int, last: list[int], suffixes: dict) -> int:
        """The last token of the encoding of the first ``at`` symbols; last[i] is that of the first i."""
        fits = self.fits
        while at:
            at -= 1
            entry = suffixes.get(path[at])
            if entry is None:
                break
            token, suffixes = entry
            if token >= 0:
                if not at:
                    return token
                pair = last[at] << 32 | token
                known = fits.get(pair)
                if known is None:
                    known = fits[pair] = self.fit(last[at], token)
                if known:
                    return token
        raise ValueError(f"no encoding of {path!r}")  # every byte is a token, so this cannot be

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Encodes distinct words by one walk over their trie.

        The words are inserted in the order of their symbols, which is the
        depth-first order of the trie: only the path to the last word is kept,
        with the states of its nodes, and a word adds the nodes below the
        prefix that it shares with the one before.
        """
        symbols, inner, tokens = self.symbols, self.inner, self.tokens
        found: dict[str, list[int]] = {}
        before, last, steps = "", [-1], []  # steps[i]: length of the last token of the first i + 1 symbols
        for path, word in sorted(("".join([symbols[b] for b in word.encode()]), word) for word in words):
            shared, most = 0, min(len(before), len(path))
            while shared < most and before[shared] == path[shared]:
                shared += 1
            del last[shared + 1 :], steps[shared:]
            for at in range(shared + 1, len(path) + 1):
                token = self.last_token(path, at, last, inner)
                last.append(token)
                steps.append(len(tokens[token]))
            found[word] = self.close(path, last, steps)
            before = path
        return found

    def close(self, path: str, last: list[int], steps: list[int]) -> list[int]:
        """The encoding of the whole word ``path``: its closing token, then the states read backwards."""
        closing = self.last_token(path, len(path), last, self.closing)
        out, at = [closing], len(path) - (len(self.tokens[closing]) - len(END))
        while at:
            out.append(last[at])
            at -= steps[at - 1]
        return out[::-1]


def suffix_trie(tokens: dict[str, int]) -> dict:
    """Tokens read from their ends: trie[symbol] = [token or -1, trie of the symbols before]."""
    root: dict = {}
    for text, token in tokens.items():
        node = root
        for symbol in reversed(text):
            entry = node.setdefault(symbol, [-1, {}])
            node = entry[1]
        entry[0] = token
    return root


def normalised(text: str) -> str:
    """NFC, then lower case letter by letter (a final sigma is no exception)."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("\u03a3", "\u03c3").lower()


OUTPUTS = StructType().add("bpe_ids", BinaryType()).add("bpe_count", LongType()).add("bpe_text", StringType())


def encode_decode(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, known_words: int = 400_000,
                  keep: list[str] | None = None) -> DataFrame:
    """Adds ``bpe_ids`` (ids as packed little-endian unsigned 32-bit integers),
    ``bpe_count`` and ``bpe_text`` (the ids decoded again, special tokens kept).

    The tokenizer file is read on the driver, which checks its vocabulary and
    broadcasts the tables (their size is the file's). A worker remembers, from
    task to task, the encodings of at most about ``known_words`` distinct words
    and then starts afresh, which changes its memory and never a result.

    Defined cases: a null or empty text has no ids and decodes to the empty
    text; a word of any length is encoded whole; special tokens written in a
    text get their ids, as in the library.
    """
    with open(tokenizer, encoding="utf-8") as f:
        tables = vars(WordEncoder(json.load(f)))
    # plain dicts: a worker unpickles them once and keeps them, so what a task adds to a memo serves the next one
    sent = df.sparkSession.sparkContext.broadcast(tables | {"known": {}})

    def make() -> Callable[[list[str]], list]:
        encoder = WordEncoder.of(sent.value)
        pattern, specials = regex.compile(WORDS), regex.compile("(" + "|".join(map(regex.escape, encoder.specials)) + ")")
        known: dict[str, tuple[bytes, str]] = sent.value["known"]  # the packed ids and the text they decode to
        tokens = encoder.tokens

        def learn(encoded: dict[str, list[int]]) -> None:
            packed = np.fromiter(chain.from_iterable(encoded.values()), "<u4").tobytes()
            at = 0
            for word, ids in encoded.items():
                end = at + 4 * len(ids)
                known[word] = packed[at:end], " ".join([tokens[i] for i in ids])
                at = end

        def work(texts: list[str]) -> list:
            if len(known) > known_words:
                known.clear()
            learn({s: [i] for s, i in encoder.specials.items()})
            docs = [
                list(chain.from_iterable(
                    [part] if k % 2 else pattern.findall(normalised(part)) for k, part in enumerate(specials.split(text))
                )) if any(s in text for s in encoder.specials) else pattern.findall(normalised(text))
                for text in texts
            ]
            fresh = set(chain.from_iterable(docs)) - known.keys()
            learn(encoder.encode_words(fresh))
            found = [[known[w] for w in words] for words in docs]
            packed = [b"".join([ids for ids, _ in words]) for words in found]
            decoded = [" ".join([word for _, word in words]) for words in found]
            return [pa.array(packed, pa.binary()), [len(p) // 4 for p in packed], decoded]

        return work

    return with_text_columns(df, text, OUTPUTS, make, keep)


def op6_bpe(spark, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """Every document encoded and decoded; digests of the ids and of the decoded text."""
    coded = encode_decode(table(spark, sf_dir, "documents"), tokenizer=tokenizer, keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.col("bpe_count").alias("n_tokens"),
        F.sha2("bpe_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("bpe_text").cast("binary"), 256).alias("decoded_sha256"),
    )
