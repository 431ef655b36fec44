"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty
tables, extra columns with clashing names; each against brute force where there is one."""

import hashlib
import json
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ingot.llm import (
    chat,
    decontam,
    known_licenses,
    langid,
    licenses,
    packing,
    pii,
    rangecoder,
    simhash,
    tokenfile,
    tokens,
    topk,
    toxicity,
)
from ingot.llm.common import remove_written, ship, text_batches, written
from ingot.session import fresh_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Clashing names: what the operators call their own columns.
EXTRA = ", fp long, score string, start string, length int, ids string, key string, digest int"
ODD = ["", " ", "\n\t", "a", "one two", "a  b", "x \n y", "1" * 5000, "word " * 3000,
       "<|endoftext|> é ñ ß", "Ωμέγα ΣΑΣ", "漢字 かな", "!!! ???", "\x01 \x1c \x00"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows: nulls in every column, repeated rows, equal texts, clashing columns."""
    ship(spark)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(ODD)]
    rows += [rows[4], rows[4], (None, "no id here", None, None, None), (90, None, None, None, None),
             (91, ODD[8], "de", None, 3)]
    return spark.createDataFrame([(*r, 1, "x", "y", 2, "z", "k", 3) for r in rows], DOCS + EXTRA)


@pytest.fixture(scope="module")
def none(spark, odd):
    return odd.limit(0)


def real(spark, name="documents"):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


# Tokens, range coder, token files

@pytest.mark.parametrize(("path", "spaces"), [(BYTES, "lead"), (WORDS, "drop")])
def test_pieces_equal_whole_texts(path, spaces):
    plain = Tokenizer.from_file(path)
    encoder = tokens.PieceEncoder(path, spaces, max_pieces=50)
    rng = random.Random(5)
    texts = [*ODD, *("".join(rng.choice("ab. ,'s\n\t é1 　\x1f́") for _ in range(40))
                     for _ in range(300))]
    for lo in range(0, len(texts), 20):
        part = texts[lo:lo + 20]
        ids, lengths = encoder.encode(part, 2)
        want = [plain.encode(t, add_special_tokens=False).ids + [2] for t in part]
        assert ids.tolist() == [i for w in want for i in w]
        assert lengths.tolist() == [len(w) for w in want]


def test_intermediate_tables_can_be_removed(spark):
    first = written(spark.range(3).toDF("x"), "t-gone")
    assert first.count() == 3 and remove_written(spark) >= 1
    with pytest.raises(Exception, match="(?i)file|path"):
        first.collect()
    assert remove_written(spark) == 0


def test_empty_rows_fill_a_group():
    batch = pa.RecordBatch.from_arrays([pa.array(range(100_000)), pa.nulls(100_000, pa.string())],
                                       ["doc_id", "text"])
    groups = [len(keys) for keys, _ in text_batches(iter([batch]), 200_000)]
    assert sum(groups) == 100_000 and max(groups) <= 200_000 // 64 + 1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 65535) | st.integers(0, 5), max_size=400), st.integers(1, 60))
def test_range_coder_round_trip(ids, block):
    ids = np.array(ids, np.uint32)
    payloads, crcs = rangecoder.encode_blocks(ids, block)
    assert rangecoder.decode_blocks(payloads, len(ids), block, crcs).tolist() == ids.tolist()


def test_range_coder_compresses_and_notices_damage():
    ids = np.tile(np.arange(50, dtype=np.uint32), 100)
    payloads, crcs = rangecoder.encode_blocks(ids, 1000)
    assert sum(map(len, payloads)) < len(ids) / 4
    bad = [bytes([payloads[0][0] ^ 0x40]) + payloads[0][1:], *payloads[1:]]
    with pytest.raises(ValueError, match="differs|damaged"):
        rangecoder.decode_blocks(bad, len(ids), 1000, crcs)
    # Blocks are independent: another block's damage leaves a block's ids alone.
    alone = rangecoder.decode_blocks(payloads[1:2], 1000, 1000, crcs[1:2])
    assert alone.tolist() == ids[1000:2000].tolist()


def test_segment_keeps_null_ids_and_checks_its_directory():
    ids = np.arange(10, dtype=np.uint32)
    frame = tokenfile.encode_segment([None, 7], np.array([4, 6]), ids, 4)
    keys, lengths, back = tokenfile.decode_segment(frame)
    assert (keys, lengths.tolist(), back.tolist()) == ([None, 7], [4, 6], ids.tolist())
    with pytest.raises(ValueError, match="directory"):
        tokenfile.decode_segment(frame[:40] + bytes([frame[40] ^ 1]) + frame[41:])


def test_token_file_round_trip(spark, odd):
    path = fresh_path(spark, "t-tokens")
    tokenfile.write_tokens(odd, path, BYTES, block=64, segment_ids=500, part_chars=5000)
    rows = tokenfile.read_tokens(spark, path).orderBy("start").collect()
    plain = Tokenizer.from_file(BYTES)

    def ids(text):
        return (*plain.encode(text or "", add_special_tokens=False).ids, 2)
    want = Counter((r.doc_id, ids(r.text)) for r in odd.collect())
    got = [(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows]
    assert Counter(got) == want
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(len(rows))]
    keys = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert keys == sorted(keys)


def test_token_file_of_nothing(spark, none):
    path = fresh_path(spark, "t-tokens")
    tokenfile.write_tokens(none, path, BYTES)
    assert tokenfile.read_tokens(spark, path).count() == 0


# Packing

@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 300), min_size=1, max_size=200), st.sampled_from([16, 64, 100]))
def test_pack_group_covers_every_id_once(lengths, window):
    rows = packing.pack_group(np.array(lengths), window)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for d, start, n, seq, offset in rows.tolist():
        by_doc[d].append((start, n))
        by_seq[seq].append((offset, n))
    for d, n in enumerate(lengths):
        at = 0
        for start, size in sorted(by_doc[d]):
            assert start == at and size > 0
            at += size
        assert at == n
    open_ends = 0
    for parts in by_seq.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= window
        if at < window:
            assert at & (at - 1) == 0
            open_ends += 1
    assert open_ends <= window.bit_length()


def test_least_squares_fits_what_can_be_fitted():
    hist = np.zeros(65, np.int64)
    hist[[24, 40, 32, 10, 22]] = [30, 30, 20, 6, 6]
    patterns = packing.combinations(hist, 64)
    x = packing.solve_counts(patterns, hist)
    fitted = np.zeros(65)
    for p, v in zip(patterns, x, strict=True):
        assert p.sum() == 64
        for a in p[p > 0]:
            fitted[a] += v
    assert np.abs(fitted - hist)[[24, 40, 32]].max() < 4


def test_packing_of_odd_rows(spark, odd, none):
    rows = packing.pack_documents(odd, WORDS, group_ids=3000).collect()
    plain = Tokenizer.from_file(WORDS)
    total = sum(len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1
                for r in odd.collect())
    assert sum(r.length for r in rows) == total
    assert all(len(r.ids) == 4 * r.length for r in rows)
    seqs = defaultdict(int)
    for r in rows:
        seqs[r.sequence_id] += r.length
    assert all(n == 4096 or n & (n - 1) == 0 for n in seqs.values())
    assert packing.pack_documents(none, WORDS).count() == 0


# Exact top-k

def brute_top_k(rows, asked, k):
    ok = {i: [int(np.floor(256 * np.float64(x))) for x in v] for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q in asked:
        if q in ok:
            best = sorted((-sum(a * b for a, b in zip(ok[q], v, strict=True)), i)
                          for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def test_top_k_with_ties_nulls_and_copies(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(200)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 280)]            # a large tie
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4),
             (303, [float("inf"), 0.0, 0.0, 0.0]), (304, [1.0]), (305, []), (None, [1.0] * 4),
             (350, [3.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows],
                               "vec_id long, embedding array<float>, score long, bin string")
    asked = [i for i, _ in rows if i is not None and i % 50 == 0]
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), k=5)
    as32 = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert {tuple(r) for r in got.collect()} == brute_top_k(as32, asked, 5)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_of_few_candidates_and_wide_scores(spark):
    df = spark.createDataFrame([(0, [1000.0, -2000.0]), (1, [3000.5, 7.0]), (2, [-9.0, 4e5])],
                               "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.top_k(df, df, k=5).collect()}
    assert got == brute_top_k([tuple(r) for r in df.collect()], [0, 1, 2], 5)


# Licences

def test_license_forms(spark, odd, none):
    mit = next(t for n, t in licenses.TEXTS if n == "MIT")
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(" ", "   ")),
            (2, mit.replace("sublicense", "sublicence").replace('"', "'")), (3, mit + " and more"),
            (4, "Text before.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.\n"),
            (5, "released under the MIT licence"), (6, ""), (7, None), (7, None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "doc_id long, text string, digest string, license string")
    got = [(r.doc_id, r.license, r.line_licenses) for r in
           licenses.scan(df, licenses.known_digests(spark)).orderBy("doc_id").collect()]
    assert got == [(1, "MIT", ""), (2, "MIT", ""), (3, None, ""), (4, None, "CC-BY-NC-4.0,MIT"),
                   (5, "MIT", "MIT"), (6, None, ""), (7, None, ""), (7, None, "")]
    assert licenses.scan(odd, licenses.known_digests(spark)).count() == odd.count()
    assert licenses.scan(none, licenses.known_digests(spark)).count() == 0


def test_whole_licences_under_other_layouts(spark):
    whole = known_licenses.system_texts()
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= {
        n for n, _ in whole}
    layouts = [lambda t: t.upper(), lambda t: "\n\n".join("\t" + x.replace(" ", "  ") for x in t.split("\n")),
               lambda t: t.replace("\n", "\r\n") + "\n\n", lambda t: re.sub(r"\blicense(s?)\b", r"licence\1", t)]
    rows = [(i * 10 + j, change(text)) for i, (_, text) in enumerate(whole)
            for j, change in enumerate(layouts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan(df, licenses.known_digests(spark)).collect()}
    assert got == {i: whole[i // 10][0] for i, _ in rows}


def test_titles_and_lines_without_a_year(spark):
    mit = next(t for n, t in licenses.TEXTS if n == "MIT")
    rows = [(1, "Copyright Jane Doe\n\n" + mit), (2, "The MIT License (MIT)\n\nCopyright (c) Jane Doe\n" + mit),
            (3, "MIT License\n\nCopyright J. R. van Doe, Acme\n\n" + mit),     # "van" is no capitalised name
            (4, "Copyright notice and more words\n\n" + mit)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan(df, licenses.known_digests(spark)).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: None, 4: None}


def test_any_notice_of_the_caller_is_looked_up(spark):
    long = "Use is granted " + "to everybody and " * 40 + "to nobody else."
    notices = [("GPL", "Distributed under the terms of the GPL."), ("LONG", long), ("X", "ok")]
    rows = [(1, "a\n  distributed under the terms of the GNU GPL!\nb"), (2, long.upper()), (3, "OK"),
            (4, "not ok"), (5, "licence licence"), (6, "x" * 500_000 + "\nok")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = licenses.known_digests(spark, [("TWICE", "license license")])
    got = {r.doc_id: (r.license, r.line_licenses) for r in licenses.scan(
        df, known, licenses.known_digests(spark, notices)).collect()}
    assert got == {1: (None, "GPL"), 2: (None, "LONG"), 3: (None, "X"), 4: (None, ""), 5: ("TWICE", ""),
                   6: (None, "X")}


# Chat

def test_rotation_renders_each_view(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", "yo"), (1, 2, "ann", None), (1, 2, "ann", None),
            (1, None, None, "first"), (2, 0, "ann", "alone"), (None, 0, "ann", "lost")]
    rows += [(3, i, f"p{i % 3}", f"turn {i}") for i in range(700)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, "
                               "speaker string, start int")
    views = defaultdict(list)
    for r in chat.rotate(df).collect():
        views[r.conv_id, r.speaker].append(r)
    assert {k for k in views if k[0] < 3} == {(1, "ann"), (1, "bob"), (1, "unknown"), (2, "ann")}
    for (conv, speaker), parts in views.items():
        parts.sort(key=lambda r: r.start)
        whole = "".join(r.text for r in parts)
        at = 0
        for r in parts:
            assert r.start == at and r.masked == (r.author == speaker)
            assert r.role == ("assistant" if r.author == speaker else "user")
            head = "<|assistant|>" if r.masked else f"<|user name={r.author}|>"
            assert r.text.startswith(head)
            assert whole[r.mask_start:r.mask_end] in {t or "" for c, _, _, t in rows if c == conv}
            at += len(r.text)
    assert "".join(r.text for r in views[1, "ann"]) == (
        "<|user name=unknown|>\nfirst<|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\nyo<|end|>\n"
        "<|assistant|>\n<|end|>\n<|assistant|>\n<|end|>\n")
    assert len(views[3, "p1"]) == 700
    assert chat.rotate(df.limit(0)).count() == 0


@pytest.mark.parametrize("turn", [None, 5])
def test_a_dialogue_of_equal_turns_is_spread(spark, monkeypatch, turn):
    monkeypatch.setattr(chat, "BUCKET", 16)
    rows = [(1, turn, f"p{i % 2}", f"{'same beginning ' * 8}{i % 300}") for i in range(900)]
    rows += [(1, turn, "p0", "copy")] * 500 + [(2, 0, "x", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    views = defaultdict(list)
    for r in chat.rotate(df).collect():
        views[r.conv_id, r.speaker].append(r)
    assert len(views[1, "p0"]) == len(views[1, "p1"]) == 1400
    for parts in views.values():
        parts.sort(key=lambda r: r.start)
        at, seen = 0, []
        for r in parts:
            assert r.start == at
            at += len(r.text)
            seen.append((r.author, r.text))
        assert [a for a, _ in seen] == sorted(a for a, _ in seen)
        assert sum(t.endswith("copy<|end|>\n") for _, t in seen) in (0, 500)


# Personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def ok(kind, s):
        digits = re.sub(r"[^0-9]", "", s)
        return {"email": True, "ip": all(len(p.lstrip("0")) < 4 and int(p) <= 255
                                         for p in s.split(".")) if kind == "ip" else 0,
                "card": 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15}[kind]
    return {k: [m.span() for m in re.finditer(p, text) if ok(k, m.group())]
            for k, p in PATTERNS.items()}


@settings(max_examples=300, deadline=None)
@given(st.text("a@.-5 0+%(é", max_size=60) | st.text("4. -1+", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_personal_data_of_odd_rows(spark, odd, none):
    extra = spark.createDataFrame(
        [(200, "call +1 (743) 555-3824 or write to a.b@c.example.com", "en", "s", 0, 1, "x", "y", 2,
          "z", "k", 3),
         (201, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" 4111 1111 1111 1111', "en", "s",
          0, 1, "x", "y", 2, "z", "k", 3)], odd.schema)
    docs = odd.unionByName(extra)
    weights = pii.fit(docs)
    rows = pii.find(docs, weights).collect()
    assert len(rows) == docs.count()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    for r in rows:
        want = [plain_spans(t) for t in texts[r.doc_id]]
        got = {k: [(s.start, s.end) for s in r.base if s.kind == k] for k in PATTERNS}
        assert got in want
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))
    by = {r.doc_id: r for r in rows}
    assert (by[200].n_phone, by[200].n_email, by[201].n_card) == (1, 1, 1)
    assert "secret" in {s.kind for s in by[201].spans}
    clean = {r.doc_id: r for r in pii.redact(docs, weights).collect()}
    assert clean[200].text == "call <PHONE> or write to <EMAIL>"
    assert clean[201].text == "<SECRET> <CARD>"
    assert clean[90].text is None and clean[201].lang == "en"
    assert pii.find(none, pii.fit(none)).count() == 0
    assert pii.redact(none, pii.fit(none)).count() == 0


def test_every_spelling_of_an_obfuscated_email_goes(spark, odd):
    spelled = [f"jane{a}example{d}com" for a in ("(at)", " (at) ", "[at]", " [AT] ", " at ", " AT ")
               for d in (".", "(dot)", " (DOT) ", "[dot]", " [dot] ", " dot ", " DOT ", " . ")]
    prose = ["We met at noon. Then they left at six. Nobody stayed at home. Fine.",
             "It opens at 9.30 and closes at 17.45 each day.",
             "We bought the tickets at amazon.com yesterday.", "The code is hosted at github.io.",
             "She works at booking.com in town.", "A packet arrived at node.info again."]
    rows = [(i, f"mail {t} soon") for i, t in enumerate(spelled)] + [
        (900 + i, t) for i, t in enumerate(prose)] + [
        (950, "I was at home. jane (at) example.com is new. bob at example.org. Thanks a lot.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ship(spark)
    clean = {r.doc_id: r.text for r in pii.redact(docs, pii.fit(docs)).collect()}
    assert {clean[i] for i in range(len(spelled))} == {"mail <OBFUSCATED_EMAIL> soon"}
    assert [clean[900 + i] for i in range(len(prose))] == prose
    assert clean[950] == ("I was at home. <OBFUSCATED_EMAIL> is new. <OBFUSCATED_EMAIL>. "
                          "Thanks a lot.")


def test_many_spans_in_one_text_take_linear_work():
    line = "10.0.0.{} token=abcdef{} x@example{}.com call 555-010-{:04d}\n"
    texts = ["".join(line.format(i % 250, i, i, i % 9999) for i in range(n)) for n in (5000, 20000)]
    took = []
    for text in texts:
        start = time.thread_time()
        base, spans = pii.all_spans(text, np.ones(pii._features(np.zeros((1, 9), int)).shape[1]))
        took.append(time.thread_time() - start)
        assert len(base["ip"]) == len(base["email"]) == text.count("\n")
        assert len(spans) >= 3 * text.count("\n")
    assert took[1] < 10 * took[0]


def test_long_secrets_and_ibans_go_whole(spark, odd):
    rng = random.Random(3)
    token = "".join(rng.choices("abcdefghijkmnopqrstuvwxyzABCDEF", k=600))
    ibans = ["DE89370400440532013000", "FR1420041010050500013M02606", "GB29NWBK60161331926819",
             "IT60X0542811101000000123456", "ES9121000418450200051332", "NO9386011117947",
             "MT84MALT011000012345MTLCAST001S"]
    spaced = [" ".join(i[j:j + 4] for j in range(0, len(i), 4)) for i in ibans]
    rows = [(i, f"my IBAN {t} BANK") for i, t in enumerate(ibans + spaced)] + [
        (100, f"token={token} end"), (101, f'api_key: "{token}" end'),
        (102, f"token={token},a.b@c.example.com;{token} end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ship(spark)
    weights = pii.fit(docs)
    clean = {r.doc_id: r.text for r in pii.redact(docs, weights).collect()}
    assert {clean[i] for i in range(len(rows) - 3)} == {"my IBAN <IDENTIFIER> BANK"}
    assert (clean[100], clean[101]) == ("<SECRET> end", "<SECRET> end")
    assert clean[102] == "<SECRET><EMAIL><SECRET> end"


def test_em_prefers_agreeing_labelers():
    patterns = np.array([[0, 1, 1, 1, 0, 0, 1], [0, -1, -1, 0, 0, -1, -1], [0, 1, 1, -1, 0, 0, 1]])
    soft, learned = pii.em(patterns, np.array([100.0, 100.0, 5.0]))
    assert soft[0] > 0.9 and soft[1] < 0.1 and soft[2] > 0.5
    assert learned["reliability"].shape == (2, 6, 3)


# SimHash

def brute_components(fps, tau=3):
    ids = sorted(fps)
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if low[a] > low[b] and (fps[a] ^ fps[b]).bit_count() <= tau:
                    low[a], changed = low[b], True
    return low


@pytest.mark.parametrize("parts", [4, 2])
def test_every_link_is_found(spark, monkeypatch, parts):
    ship(spark)
    monkeypatch.setattr(simhash, "choose_parts", lambda *a: parts)
    rng = random.Random(parts)
    fps = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(6):
            fps.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    fps |= {0, 1, 3, (1 << 64) - 1}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    got = {tuple(r) for r in simhash.links(df).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in signed for b in signed
            if a < b and ((a & mask) ^ (b & mask)).bit_count() <= 3}
    assert got == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 201)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.root for r in simhash.components(df).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100),
                   200: 200, 201: 200}
    assert simhash.components(df.limit(0)).count() == 0


def test_near_duplicates_of_odd_rows(spark, odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    fps = {r.doc_id: simhash.fingerprint(r.text or "") for r in odd.collect()
           if r.doc_id is not None}
    low = brute_components(fps)
    assert all(r.component_id == low[r.doc_id] for r in rows if r.doc_id is not None)
    rows = simhash.keep_representatives(odd).collect()
    kept = [r.doc_id for r in rows if r.doc_id is not None]
    assert sorted(kept) == sorted(set(low.values()))
    assert [r.text for r in rows if r.doc_id is None] == ["no id here"]
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_representatives(none).columns == none.columns


def test_texts_that_share_an_id_keep_a_row_of_each_group(spark):
    ship(spark)
    x, y, z = (" ".join(f"{w}{i}" for i in range(40)) for w in "xyz")
    rows = [(3, x, "a"), (5, x, "b"), (5, y, "c"), (5, z, "d"), (5, z, "e"), (5, z, "e"),
            (7, y, "f"), (9, z, "g")]
    one, other = (simhash.keep_representatives(spark.createDataFrame(
        r, "doc_id long, text string, fp string").repartition(3)) for r in (rows, rows[::-1]))
    kept = sorted(map(tuple, one.collect()))
    assert [r[:2] for r in kept] == [(3, x), (5, y), (5, z)]
    assert kept == sorted(map(tuple, other.collect())) and one.columns == ["doc_id", "text", "fp"]


def test_rows_without_an_id_leave_one_of_each_group(spark):
    ship(spark)
    x, y, z = (" ".join(f"{w}{i}" for i in range(40)) for w in "xyz")
    near = y + " more"                           # two fingerprints of one group
    assert 0 < (simhash.fingerprint(y) ^ simhash.fingerprint(near)).bit_count() <= 8
    rows = [(3, x), (None, x), (None, y), (None, y), (None, near), (None, z), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in simhash.keep_representatives(df, tau=8).collect()]
    assert sorted(kept, key=str) in (sorted([(3, x), (None, t), (None, z), (None, None)], key=str)
                                     for t in (y, near))


def test_fingerprint_follows_its_definition():
    import xxhash
    text = "One two THREE\x0bfour é one two three"
    words = ["one", "two", "three", "four", "é", "one", "two", "three"]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(6)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 6)
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("Two words") == xxhash.xxh64_intdigest("two words", 42)
    assert simhash.fingerprint(" \n") == 0


def test_thresholds_spend_the_whole_budget():
    rng = np.random.default_rng(2)
    costs = np.cumsum(rng.random((50, 4, 5)), axis=2)
    costs[:, :, 0] = 0
    chosen = simhash.allocate(costs, 3)
    assert (chosen.sum(1) + 4 == 4).all()
    spent = np.take_along_axis(costs, chosen[:, :, None] + 1, 2)[:, :, 0].sum(1)
    for r in range(5):
        best = min(sum(costs[r, p, u] for p, u in enumerate((a, b, c, 4 - a - b - c)))
                   for a in range(5) for b in range(5 - a) for c in range(5 - a - b))
        assert abs(spent[r] - best) < 1e-9


# Decontamination

def test_contaminated_texts_are_found(spark, odd, none):
    item = "the quick brown fox jumps over one lazy dog while seven cats look on from high walls"
    words = item.split()
    changed = [*words]
    for i in (2, 9):
        changed[i] = "zzz"
    rows = [(1, "Before. " + item.upper() + "! After."), (2, " ".join(changed)),
            (3, " ".join(reversed(words))), (4, " ".join(words[:6])), (5, None), (1, item),
            (None, item), (6, "x " * 50 + " ".join(words[3:17]) + " y" * 50)]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows],
                                 "doc_id long, text string, item_id int, pos string")
    items = spark.createDataFrame([(7, item), (7, item), (8, "too short"), (9, None), (None, item)],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in decontam.contaminated(docs, items).collect()}
    assert set(got) == {(1, 7), (2, 7), (6, 7)}
    assert got == {(1, 7): 17, (2, 7): 13, (6, 7): 14}
    kept = decontam.keep_clean(docs, items)
    # The row without an id holds the item too, and goes by its text.
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [3, 4, 5]
    assert kept.columns == docs.columns
    assert decontam.contaminated(odd, items).count() == 0
    assert decontam.contaminated(none, items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


def test_long_items_stay_below_the_bytes_of_a_pass(spark, monkeypatch):
    rng = random.Random(4)
    long = {i: [f"v{rng.randrange(9000)}" for _ in range(1000)] for i in range(12)}
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in long.items()],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(["a", *w[i:i + 30], "b"])) for i, w in long.items()],
                                 "doc_id long, text string")
    seeds = decontam.test_seeds(decontam.test_items(items, "item_id", "text").withColumn(
        "variant", F.lit(0)))
    assert set(seeds.columns) == {"h", "item_id", "ipos", "variant"}      # no words
    one = {tuple(r) for r in decontam.contaminated(docs, items).collect()}
    assert one == {(i, i, 30, 1000) for i in long}
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 300_000)             # about ten passes
    assert {tuple(r) for r in decontam.contaminated(docs, items).collect()} == one


def test_short_items_count_where_they_are_the_whole_text(spark):
    docs = spark.createDataFrame([(1, "Paris"), (2, "We went to Paris once."), (3, "paris!"), (4, None),
                                  (5, "one two three four five"), (6, "one two three four six")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(7, "Paris."), (8, "one two three four five"), (9, " ")],
                                  "item_id long, text string")
    got = {tuple(r) for r in decontam.contaminated(docs, items).collect()}
    assert got == {(1, 7, 1, 1), (3, 7, 1, 1), (5, 8, 5, 5)}


def test_rows_are_judged_by_their_texts(spark):
    item = "the quick brown fox jumps over one lazy dog while seven cats look on from high walls"
    docs = spark.createDataFrame([(None, item), (None, "clean"), (4, item), (4, "also clean"), (5, None)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = [tuple(r) for r in decontam.keep_clean(docs, items).collect()]
    assert sorted(kept, key=str) == sorted([(None, "clean"), (4, "also clean"), (5, None)], key=str)


def test_several_passes_give_the_same(spark, monkeypatch):
    docs, items = real(spark), real(spark, "benchmark")
    one = {tuple(r) for r in decontam.contaminated(docs, items).collect()}
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 100_000)
    assert {tuple(r) for r in decontam.contaminated(docs, items).collect()} == one
    texts = {r.doc_id: r.text for r in docs.collect()}
    exact = {(d, r.item_id) for r in items.collect() for d, t in texts.items() if r.text in t}
    assert exact <= {r[:2] for r in one}


def brute_matched(doc, item):
    """Matched words of the best stretch, over all diagonals."""
    top = 0
    for d in range(-len(item) + 1, len(doc)):
        total = hits = best = matched = 0
        for i, w in enumerate(item):
            same = 0 <= d + i < len(doc) and doc[d + i] == w
            total = max(0, total + (1 if same else -2))
            hits = hits + same if total else 0
            if total > best:
                best, matched = total, hits
        top = max(top, matched)
    return top


def test_every_accepted_substitution_is_found(spark):
    rng = random.Random(5)
    sizes = [1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 11, 12, 16, 16, 17, 40]
    items = {i: [f"w{i}x{rng.randrange(3 * n)}" for _ in range(n)] for i, n in enumerate(sizes)}
    docs = {0: items[12][:7] + ["a", "b"] + items[12][9:], 1: ["a"] + items[7][1:],
            2: items[7][:-1] + ["a"]}
    for item in items.values():
        for _ in range(40):
            words = [w if rng.random() < 0.85 else "zz" for w in item]
            cut = rng.choice([0, 0, 1, 3])
            docs[len(docs)] = ["yy"] * rng.choice([0, 2]) + words[cut:] + ["xx"] * rng.choice([0, 2])
        for k in (3, 4, 5):                       # a word of every k replaced
            docs[len(docs)] = ["zz" if j % k == k - 1 else w for j, w in enumerate(item)]
    want = {(d, i): m for d, doc in docs.items() for i, item in items.items()
            if (m := brute_matched(doc, item)) >= min(13, 0.8 * len(item))
            and (len(item) > decontam.SHORT or doc == item)}
    assert {(0, 12), (1, 7), (2, 7)} <= set(want) and len({i for _, i in want}) == len(items)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    tests = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in decontam.contaminated(df, tests).collect()}
    assert got == want


# Language and toxicity

def test_languages(spark, odd, none):
    docs = real(spark)
    profiles = langid.train_profiles(docs, F.col("doc_id") % 5 != 0)
    want = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.identify(docs.where("doc_id % 5 = 0"), profiles).collect()
    assert sum(r.lang_pred == want[r.doc_id] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    strange = {r.doc_id: r for r in langid.identify(odd, profiles).collect()}
    assert all(strange[i].lang_pred == "und" for i in (0, 1, 2, 7, 12, 90))
    assert langid.identify(odd, profiles).count() == odd.count()
    assert langid.identify(none, profiles).count() == 0
    assert langid.train_profiles(none, F.lit(True)) == {}
    assert {r.lang_pred for r in langid.identify(odd, {}).collect()} == {"und"}
    assert langid.accept(docs, profiles).count() >= 0.98 * docs.count()
    assert langid.accept(odd, profiles).columns == odd.columns
    assert langid.accept(none, {}).count() == 0
    with pytest.raises(Exception, match="no language profile"):
        langid.accept(docs, {}).count()
    with pytest.raises(ValueError, match="more than 2 values"):
        langid.train_profiles(docs, F.lit(True), max_languages=2)


def test_long_texts_are_counted_in_slices():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("ab 1é\n") for _ in range(rng.randint(0, 40)))
        whole = langid.gram_counts(text)
        for size in (1, 2, 3, 7):
            assert [x.tolist() for x in langid.gram_counts(text, size)] == [
                x.tolist() for x in whole]


def test_out_of_place_distance():
    matcher = langid.Matcher({"a": langid.ranking("abc abc abd", 10),
                              "b": langid.ranking("xyz xyz xyy", 10)}, 10)
    assert matcher.distances("abc abc abd")[0] == 0
    assert matcher.distances("abc abc abd")[1] == 1
    assert matcher.predict("...") == ("und", 0.0)


def test_toxic_words_are_learnt(spark, odd, none):
    ship(spark)
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, marks = [], []
    for i in range(700):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 200))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["nastyword", "vileword"])
        rows.append((i, " ".join(words), "en", "s", 0, 1, "x", "y", 2, "z", "k", 3))
        marks.append((i, int(toxic), "t"))
    docs = spark.createDataFrame(rows, odd.schema)
    labels = spark.createDataFrame([*marks, (None, 1, "t"), (3, None, "t")],
                                   "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 1, sample_rows=600, steps=200)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(i, t) for i, t, _ in marks if i % 3 == 1]
    assert sum(got[i].predicted == t for i, t in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert toxicity.score(odd, model).count() == odd.count()
    assert toxicity.score(none, model).count() == 0
    nothing = toxicity.fit(none, labels, F.lit(True))
    assert {r.score for r in toxicity.score(odd, nothing).collect()} == {0.0}


def test_every_labelled_row_teaches_toxicity(spark, odd):
    """Many rare toxic words: a sample of 200 rows, or a shard of them, holds too few of each."""
    ship(spark)
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    bad = ["".join(rng.choice("mnopqrst") for _ in range(7)) for _ in range(25)]
    rows, marks = [], []
    for i in range(2400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        if i % 5 == 0:
            words[rng.randrange(len(words))] = bad[i // 5 % len(bad)]
        rows.append((i, " ".join(words), "en", "s", 0, 1, "x", "y", 2, "z", "k", 3))
        marks.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, odd.schema)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 1, sample_rows=200, steps=100)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    held = [(i, t) for i, t in marks if i % 3 == 1]
    assert sum(got[i] == t for i, t in held) >= 0.97 * len(held)


def test_digests_are_what_the_contract_says(spark):
    """spans and base_sha256 of the registered query, recomputed from the texts."""
    from ingot.llm.queries import QUERIES
    texts = {r.doc_id: r.text for r in real(spark).collect()}
    for r in QUERIES["op7_personal_data"](spark, SMALL).collect():
        base = plain_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k in PATTERNS for s, e in base[k])
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(base[k]) for k in PATTERNS)
    assert json.dumps(zlib.crc32(b"")) == "0"
