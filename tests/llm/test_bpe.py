from __future__ import annotations

import hashlib
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabletally.llm import bpe

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.TOKENIZER)


@pytest.fixture(scope="module")
def encoder():
    with open(bpe.TOKENIZER, encoding="utf-8") as f:
        return bpe.WordEncoder(json.load(f))


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r[0]: tuple(r)[1:] for r in bpe.op6_bpe(spark, SF).collect()}
    assert got == {i: expected(library, t) for i, t in texts.items()}


ODD = [
    None, "", "   \n\t", "Hello  wörld's 123 !!! <|endoftext|> it'S <|startoftext|>x", "é é ​ 日本語 ΑΣ ΣΑΣ İI",
    "a\x00b\x1c\x85c\xa0d", "x" * 5000, "!" * 5000, "ab" * 50_000, "<|endoftext|>" * 3, "<|ENDOFTEXT|>", "\U0001f600\U0001f468‍\U0001f469", "½²³ ٣",
    "'S'T'RE'VE'M'LL'D 'x", "Hello", "hello",
]


def test_odd_texts_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(0, None, "x"), (0, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, BPE_ids string")
    got = bpe.encode_decode(df)
    assert got.columns == ["doc_id", "text", "bpe_ids", "bpe_count", "bpe_text"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.bpe_ids, "<u4").tolist() == ids and r.bpe_count == len(ids)
        assert r.bpe_text == library.decode(ids, skip_special_tokens=False)


def test_empty_table(spark):
    assert bpe.encode_decode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="abcdeghilnorstuy", min_size=1, max_size=24), min_size=1, max_size=30))
def test_trie_walk_equals_the_library(library, encoder, words):
    found = encoder.encode_words(set(words))
    for w in words:
        assert found[w] == library.encode(w, add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    a = {r.doc_id: bytes(r.bpe_ids) for r in bpe.encode_decode(docs).collect()}
    b = {r.doc_id: bytes(r.bpe_ids) for r in bpe.encode_decode(docs, known_words=10).collect()}
    assert a == b


def test_border_rule_equals_plain_merging(encoder):
    draw = np.random.default_rng(1)
    inner = [i for t, i in encoder.ids.items() if encoder.merge(encoder.split(t)) == [t] and not t.endswith(bpe.END)]
    ends = [i for t, i in encoder.ids.items() if encoder.merge(encoder.split(t)) == [t]]
    short = [i for i in inner if len(encoder.tokens[i]) <= 3]
    for a, b in zip(draw.choice(short, 6000), draw.choice(ends, 6000), strict=True):
        x, y = encoder.tokens[a], encoder.tokens[b]
        assert encoder.fit(a, b) == (encoder.merge([*encoder.split(x), *encoder.split(y)]) == [x, y]), (x, y)
