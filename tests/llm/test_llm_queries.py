from __future__ import annotations

import hashlib
import os

import pytest

import corpus_pipeline
from sunloom.llm import langid, toxicity
from sunloom.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.llm import brute

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r.doc_id: r for r in rows}


def _by_id(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF_DIR).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(found, connect(SF_DIR).execute(ORACLES[name]).df()) is None


def test_token_counts(spark, texts):
    library = brute.tokenizer("word_bpe_49k.json")
    found = _by_id(spark, "op3_token_counts")
    assert set(found) == set(texts)
    for k, row in found.items():
        n = len(library.encode(texts[k].text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(texts[k].text.encode()), n, n > 2048)


def _digest(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@pytest.mark.parametrize(
    "name, plain, kinds",
    [
        ("op4_personal_data", brute.personal_data, ("email", "ip", "card", "phone")),
        ("op8_secrets", brute.secrets, ("assign", "access", "hex")),
    ],
)
def test_spans(spark, texts, name, plain, kinds):
    for k, row in _by_id(spark, name).items():
        base = plain(texts[k].text)
        assert [row[f"n_{kind}"] for kind in kinds] == [sum(s[0] == kind for s in base) for kind in kinds]
        assert row.base_sha256 == hashlib.sha256(_digest(base).encode()).hexdigest()
        assert {x for x in _digest(base).split(",") if x} <= set(row.spans.split(","))


def test_language(spark, texts):
    found = _by_id(spark, "op5_language")
    held = [k for k, r in found.items() if r.held_out]
    assert held and sum(found[k].lang_pred == texts[k].lang for k in held) >= 0.9 * len(held)
    content = langid.dictionaries(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    for k, row in found.items():
        lang, score = brute.language(texts[k].text, content)
        assert (row.lang_pred, row.score) == (lang, pytest.approx(score, abs=1e-9))


def test_toxicity(spark, texts):
    found = _by_id(spark, "op7_toxicity")
    assert set(found) == set(texts)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found.values())
    model = toxicity.train(*(spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels")))
    for k, row in found.items():
        assert row.score == pytest.approx(brute.toxicity(texts[k].text, model), abs=1e-4)


def test_near_duplicates(spark, texts):
    expected = brute.components([(k, brute.simhash(r.text)) for k, r in texts.items()])
    for k, row in _by_id(spark, "op10_near_duplicates").items():
        assert row.fingerprint == f"{brute.simhash(texts[k].text):016x}" and row.component_id == expected[k]


def test_packing(spark, texts):
    library = brute.tokenizer("byte_bpe_50k.json")
    rows = QUERIES["op9_packing"](spark, SF_DIR).collect()
    lengths: dict = {}
    for r in rows:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {k: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for k, r in texts.items()}
    assert len({r.sequence_id for r in rows}) <= -(-sum(lengths.values()) // 2048) + 1


def test_pipeline_stages(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = corpus_pipeline.scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    kept = docs.collect()
    assert 0 < len(kept) < len(texts)
    assert not any(brute.contamination(texts[r.doc_id].text, items)[4] for r in kept)
    roots = brute.components([(r.doc_id, brute.simhash(texts[r.doc_id].text)) for r in kept])
    assert all(k == v for k, v in roots.items())
    assert not any(brute.personal_data(r.text) for r in kept)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in kept}
