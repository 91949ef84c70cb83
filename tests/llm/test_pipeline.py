"""The pipeline against brute force, stage by stage, each on its own input."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tabletally.llm import bpe, mixing, simhash

SF = "/root/testdata/sf0.01"
TOXIC = set("idiot moron scum trash pathetic worthless disgusting stupid loser clown".split())
PLANTED = re.compile(r'(AKIA[0-9A-Z]{16})|token = "([0-9a-f]{40})"|password=([0-9a-f]{18})')


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(name, input rows, output rows) of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((name, docs, result))
        docs = result
    return out


def test_stage_names_and_columns(stages):
    assert [s[0] for s in stages] == ["toxicity", "simhash_near_dedup", "secret_scans", "mixing", "bpe"]
    for _, docs, result in stages[:-1]:
        assert result.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    _, docs, result = stages[0]
    left = {r.doc_id: r for r in result.collect()}
    rows = docs.collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    english = [r for r in rows if r.lang == "en"]
    has = lambda t: bool(TOXIC & set(re.findall("[a-z]+", t.lower())))
    wrong = [r.doc_id for r in english if has(r.text) == (r.doc_id in left)]
    assert len(wrong) <= 0.02 * len(english)
    clean = [r.doc_id for r in rows if labels.get(r.doc_id) == 0]
    assert sum(i not in left for i in clean) <= 0.02 * len(clean)
    assert all(left[r.doc_id] == r for r in rows if r.doc_id in left)


def test_one_document_of_each_class_stays(stages):
    _, docs, result = stages[1]
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    fps = np.array([simhash.fingerprint(r.text, 3) for r in rows]).view(np.uint64)
    label = np.arange(len(rows))
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 2
    for _ in range(50):
        label = np.array([label[near[i]].min() for i in range(len(rows))])
    want = sorted({rows[i].doc_id for i in label})
    got = result.collect()
    assert sorted(r.doc_id for r in got) == want
    assert {r.doc_id: r for r in rows}.items() >= {r.doc_id: r for r in got}.items()


def test_secrets_are_replaced_and_nothing_else(stages):
    _, docs, result = stages[2]
    after = {r.doc_id: r for r in result.collect()}
    before = docs.collect()
    assert len(before) == len(after)
    for r in before:
        text = r.text
        for m in PLANTED.finditer(r.text):
            text = text.replace(next(g for g in m.groups() if g), "[secret]")
        assert after[r.doc_id].text == text and after[r.doc_id].n_chars == len(text)


def test_the_mix_takes_what_the_operator_says(stages):
    _, docs, result = stages[3]
    copies = Counter(r.doc_id for r in result.collect())
    plan = mixing.mix(docs, carry=["doc_id", "source"]).collect()
    assert copies == Counter({r.row.doc_id: r.copies for r in plan if r.copies})
    taken, target = Counter(), {}
    for r in plan:
        taken[r.row.source] += r.taken
        target[r.row.source] = r.target
    biggest = max(r.size for r in plan)
    assert all(abs(taken[s] - target[s]) <= biggest for s in target)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == texts[r.doc_id] for r in result.collect())


def test_the_last_stage_encodes_every_row(stages):
    _, docs, result = stages[4]
    library = Tokenizer.from_file(bpe.TOKENIZER)

    def coded(text):
        ids = library.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    want = Counter((r.doc_id, r.source, *coded(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.source, bytes(r.bpe_ids), r.decoded_sha256) for r in result.collect()) == want


def test_run_gives_the_last_stage(spark, stages):
    got = P.run(spark, SF)
    want = stages[-1][2]
    assert got.columns == want.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in want.collect())


def test_stages_on_odd_documents(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b", "en", "s", 3), (2, "", "en", "s", 0), (3, "w " * 30_000, "de", None, 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for part in (docs, docs.limit(0)):
        for _, stage in P.STAGES:
            out = stage(spark, part, SF)
            assert out.count() <= 3 * part.count()
