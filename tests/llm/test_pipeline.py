"""The pipeline's stages against brute force, on ordinary and on odd documents."""

import re

import corpus_pipeline
from test_llm_operators import DOCS, EXTRA, ODD, brute_components, plain_spans

from ingot.llm import simhash

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, at = docs.columns, docs
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        at = corpus_pipeline.written(stage(spark, at, SMALL), "t-stage")
        if name != "packing":
            assert at.columns == columns
            rows.append({r.doc_id: r for r in at.collect()})
    start, spoken, single, clean, private = rows
    assert set(spoken) == {i for i, r in start.items() if re.search(r"[^\W\d_]", r.text)}
    low = brute_components({i: simhash.fingerprint(r.text) for i, r in spoken.items()})
    assert set(single) == set(low.values())
    held = {i for i, r in single.items() if any(t in r.text for t in items)}
    assert not held & set(clean) and len(single) - len(clean) - len(held) <= 2
    assert set(private) == set(clean)
    for i, r in private.items():
        assert not any(plain_spans(r.text).values()) and r.n_chars == len(r.text)
        if not any(plain_spans(clean[i].text).values()) and "=" not in clean[i].text \
                and "AKIA" not in clean[i].text and "-" not in clean[i].text:
            assert r.text == clean[i].text
    whole = at.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in whole} == set(private)
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in whole)


def test_stages_of_odd_and_of_no_documents(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(ODD)]
    rows += [rows[4], rows[4], (None, "no id", None, None, None), (90, None, None, None, None)]
    odd = spark.createDataFrame([(*r, 1, "x", "y", 2, "z", "k", 3) for r in rows], DOCS + EXTRA)
    for docs in (odd, odd.limit(0)):
        at = docs
        for _, stage in corpus_pipeline.STAGES:
            at = corpus_pipeline.written(stage(spark, at, SMALL), "t-odd")
        # A row without an id goes through every stage.
        lost = at.where("doc_id IS NULL").collect()
        assert [r.length for r in lost] == ([r.doc_tokens for r in lost])
        assert len(lost) == (1 if docs is odd else 0)


def test_run_gives_the_last_stage(spark):
    df = corpus_pipeline.run(spark, SMALL)
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                          "offset"]
    assert df.count() > 100
