from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tabletally.llm import alignment

SF = "/root/testdata/sf0.001"
FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

A = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def token_bytes_a(i: int) -> bytes:
    letters = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    others = [c for c in range(256) if chr(c) not in letters]
    letters |= {chr(256 + k): c for k, c in enumerate(others)}
    return bytes(letters[c] for c in A.id_to_token(i))


def token_bytes_b(i: int) -> bytes:
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def spans(ids, to_bytes):
    out, at = [], 0
    for i in ids:
        out.append((at, at := at + len(to_bytes(i)), i))
    return out


def brute(texts: list[str | None]) -> list[tuple]:
    """The contract's columns by comparing token spans one by one."""
    docs = []
    for text in texts:
        a = b = []
        if text:
            whole = " " + text
            a = spans(A.encode(whole, add_special_tokens=False).ids, token_bytes_a)
            b = spans(B.encode(text), token_bytes_b)
            if not b"".join(token_bytes_a(i) for *_, i in a) == whole.encode() == b"".join(token_bytes_b(i) for *_, i in b):
                a = b = []
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= cut) for side in (a, b)))
            start = cut
        links, first = [], 0
        for s, e, i in a:
            while first < len(b) and b[first][1] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][0] < e:
                links.append((i, b[k][2]))
                k += 1
        docs.append((len(a), len(b), len(cuts), links, ";".join(groups)))
    held = Counter(pair for *_, links, _ in docs for pair in set(links))
    top: dict[int, int] = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    return [
        (n_a, n_b, n_groups, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), groups)
        for n_a, n_b, n_groups, links, groups in docs
    ]


def run(spark, texts, **options):
    rows = [(i, t, 1, "x", 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int, row string, links int").repartition(3)
    return [tuple(r[f] for f in FIELDS) for r in sorted(alignment.align(df, **options).collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 50, 0])
def test_documents_against_brute_force(spark, frequent, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()
    texts = [d.text for d in docs]
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 1000)
    assert run(spark, texts, frequent=frequent) == brute(texts)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    df = alignment.op13_alignment(spark, SF)
    assert dict(df.dtypes) == {
        "doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint",
        "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string",
    }
    expected = brute([d.text for d in docs])
    got = {r.doc_id: tuple(r)[1:] for r in df.collect()}
    for d, e in zip(docs, expected, strict=True):
        assert got[d.doc_id] == (*e[:-1], hashlib.sha256(e[-1].encode()).hexdigest() if e[-1] else "")


def test_pieces_have_the_tokens_of_the_whole():
    files = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read(), open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
    both = alignment.Tokenizers(*files)
    assert both.cuts_at_spaces

    @settings(max_examples=400, deadline=None)
    @given(st.text(st.sampled_from("ab ,.'s1é\n\t\r\x1c\x85\u00a0\u3000中▁ " + "the  "), max_size=40))
    def check(text):
        pieces = both.pieces(text)
        assert "".join(" " + p for p in pieces) == (" " + text if text else "")
        found = [both.one(p) for p in pieces]
        if text and None not in found:
            assert [i for a, _ in found for i in a] == A.encode(" " + text, add_special_tokens=False).ids
            assert [i for _, b in found for i in b] == B.encode(text)
        elif text:
            assert "▁" in text

    check()


ODD = [
    None, "", " ", "   ", "a", "a", "<|endoftext|>", "</s><s><unk>", "<0x41> ▁x", "\x00\x01", "\r\n\t x", "éﬁ \U0001f600",
    "中文 text", "x" * 30_000, " " * 30_000 + "b", "word " * 5_000, "﻿a​", "1234567 !!??", "a ", "a  \n  b \x1c c\u3000 d", "don't  we'll 's",
]


def test_odd_texts(spark):
    assert run(spark, ODD) == brute(ODD)
    assert run(spark, []) == []
    assert run(spark, [None, ""]) == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_white_space_runs_do_not_break_the_tokenizer():
    files = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read(), open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
    both = alignment.Tokenizers(*files)
    for text in ["a" + " " * 1_500_000 + "b", "\n" * 1_000_000, (" " * 1999 + "a") * 50]:
        assert both.tokens_a(text) == A.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1 << 40), st.integers(1, 1 << 20)), max_size=50))
def test_packing_is_reversible(pairs):
    pairs = sorted(dict(pairs).items())
    codes, times = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
    back = alignment.unpacked(alignment.packed(codes, times))
    assert back[0].tolist() == codes.tolist() and back[1].tolist() == times.tolist()
