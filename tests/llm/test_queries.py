"""Registered queries: against their SQL where there is one, else against brute force."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_oracles import _rows
from tokenizers import Tokenizer

from ingot.llm import langid, simhash, toxicity
from ingot.llm.common import remainder
from ingot.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def ids_of(name, texts):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    return {i: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
            for i, t in texts.items()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.sql(ORACLES[name])
    want = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, got) == _rows(res.columns, want)


def test_every_operator_has_a_query():
    assert [k.split("_")[0] for k in sorted(QUERIES, key=lambda k: int(k[2:].split("_")[0]))] == [
        f"op{i}" for i in range(1, 14)]


def test_token_file_query(spark, texts):
    want, at = {}, 0
    for i, ids in sorted(ids_of("byte_bpe_50k.json", texts).items()):
        want[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32)
           for r in QUERIES["op2_token_file"](spark, SMALL).collect()}
    assert got == want


def test_packing_query(spark, texts):
    ids = ids_of("word_bpe_49k.json", texts)
    rows = QUERIES["op3_packing"](spark, SMALL).collect()
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part.tobytes()), len(ids[r.doc_id]))
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for i, own in pieces.items():                     # gapless, each id in one piece
        ends = [0, *(start + length for start, length in sorted(own))]
        assert [start for start, _ in sorted(own)] == ends[:-1] and ends[-1] == len(ids[i])
    assert set(pieces) == set(ids)
    padded = {}
    for r in rows:
        padded[r.sequence_id] = padded.get(r.sequence_id, 0) + r.length
    assert all(n == 4096 or n & (n - 1) == 0 for n in padded.values())


def test_simhash_query(spark, texts):
    from test_llm_operators import brute_components
    fps = {i: simhash.fingerprint(t) for i, t in texts.items()}
    low = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in QUERIES["op8_simhash"](spark, SMALL).collect()}
    assert got == {i: (f"{fps[i]:016x}", low[i]) for i in texts}


def test_language_query(spark):
    rows = QUERIES["op1_language_id"](spark, SMALL).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def plain_ranks(texts, size=300):
    """n-grams of one to three letters, words padded by a blank, by frequency and code."""
    counts = Counter()
    for text in texts:
        letters = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " "
                          for c in text)
        line = f" {' '.join(letters.split())} "
        if line.strip():
            for n in (1, 2, 3):
                grams = (line[i:i + n] for i in range(len(line) - n + 1))
                counts.update(g for g in grams if g.strip() and (n < 3 or g[1] != " "))
    code = lambda g: (len(g), *(0 if c == " " else ord(c) for c in g))
    return {g: i for i, g in enumerate(sorted(counts, key=lambda g: (-counts[g], code(g)))[:size])}


def test_language_query_against_plain_profiles(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    learnt = {}
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None and r.text is not None:
            learnt.setdefault(r.lang, []).append(r.text)
    profiles = {name: plain_ranks(texts) for name, texts in sorted(learnt.items())}
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op1_language_id"](spark, SMALL).collect()}
    for r in docs:
        own = plain_ranks([r.text or ""])
        if not own:
            assert got[r.doc_id] == ("und", 0.0)
            continue
        away = {name: sum(abs(p[g] - i) if g in p else 300 for g, i in own.items()) / (300 * len(own))
                for name, p in profiles.items()}
        best = min(away, key=away.get)
        share = 1 / sum(np.exp(-langid.SHARPNESS * (d - away[best])) for d in away.values())
        assert got[r.doc_id][0] == best and abs(got[r.doc_id][1] - share) < 1e-9


def test_toxicity_scores_against_plain_filters(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), remainder("doc_id", 3) != 1,
                         steps=60)
    hashed, matcher = toxicity.WordHash(), langid.Matcher(model.profiles)
    some = [r for r in docs.collect() if len(r.text or "") < 3000][:40]
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(docs, model).collect()}
    for r in some:
        ids = hashed(r.text or "")
        x = np.concatenate([model.word[ids // toxicity.HEADS] + model.head[ids % toxicity.HEADS],
                            np.zeros((max(toxicity.WIDTHS), toxicity.DIM), np.float32)])
        best = []
        for f in model.filters:          # every place of every filter, one after the other
            answers = [sum(x[at + o] @ f[o] for o in range(len(f)) if at + o < len(x))
                       for at in range(len(x))]
            best.append(np.max(answers, axis=0))
        pooled = np.maximum(np.concatenate(best) + model.bias, 0)
        raw = 1 / (1 + np.exp(-float(pooled @ model.out + model.out_bias)))
        cut = model.thresholds.get(matcher.predict(r.text or "")[0], model.threshold)
        want = 0.7 + 0.3 * (raw - cut) / (1 - cut) if raw >= cut else 0.7 * raw / cut
        assert abs(got[r.doc_id][0] - want) < 1e-4
        assert got[r.doc_id][1] == int(got[r.doc_id][0] >= 0.7)


def test_long_texts_are_scored_in_slices():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, toxicity.PAD * toxicity.HEADS, n) for n in (0, 1, 5, 300, 1000)]
    model = toxicity.train(docs * 4, np.array([0, 1, 0, 1, 0] * 4, float), steps=5)
    whole = toxicity.raw_scores(model, docs)
    for size in (4, 7, 64, 999):
        assert np.allclose(toxicity.raw_scores(model, docs, size), whole, atol=1e-5)


def test_toxicity_query(spark):
    rows = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.01").collect()
    toxic = {r.doc_id: r.toxic for r in
             spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.9 * len(held)
