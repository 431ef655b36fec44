"""Byte-level BPE against tiktoken."""

import base64
import hashlib
import random
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ingot.llm import bytebpe
from ingot.llm.common import ship
from ingot.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATH = P.path("byte_bpe_50k.tiktoken")


@lru_cache
def reference(path, pattern=P.PATTERN):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    path = P.path(request.param)
    return bytebpe.worker_tools(path, P.PATTERN), reference(path)


def same(both, text):
    (splitter, encoder, decoder), plain = both
    packed = encoder.packed(splitter.pieces(text))
    assert np.frombuffer(packed, "<u4").tolist() == plain.encode_ordinary(text)
    assert decoder.bytes_of(packed) == b"".join(p.encode() for p in splitter.pieces(text))


def test_every_token_and_every_character(both):
    (splitter, encoder, _), plain = both
    for word, rank in encoder.ranks.items():
        assert encoder.ids(word) == [rank]
    every = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    for lo in range(0, len(every), 5000):
        same(both, "a".join(every[lo:lo + 5000]) + "1".join(every[lo:lo + 5000:7]))


def test_random_texts(both):
    rng = random.Random(7)
    words = [w.decode("utf-8", "ignore") for w in both[0][1].ranks]
    for _ in range(1500):
        same(both, "".join(rng.choice("abc") for _ in range(rng.randint(0, 60))))
        same(both, "".join(rng.choice(words) for _ in range(rng.randint(1, 12))))
        same(both, "".join(rng.choice("aeinrstl E  \n\t'sé<|endoftext|>") for _ in range(80)))


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_any_text(text):
    same((bytebpe.worker_tools(PATH, P.PATTERN), reference(PATH)), text)


def test_few_bytes_with_crossing_merges():
    """A small vocabulary in which the longest match is often wrong."""
    ranks = {bytes([c]): i for i, c in enumerate(b"abc")}
    for word in (b"ab", b"bc", b"ca", b"abc", b"bb", b"aab", b"abca", b"bcab"):
        ranks[word] = len(ranks)
    encoder = bytebpe.BytePairEncoder(ranks)
    rng = random.Random(1)
    for _ in range(3000):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 25)))
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while piece not in ranks:
            best = min(((ranks.get(a + b, 99), i) for i, (a, b) in
                        enumerate(zip(parts, parts[1:], strict=False))), default=(99, 0))
            if best[0] == 99:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        want = [ranks[piece]] if piece in ranks else [ranks[p] for p in parts]
        assert encoder.ids(piece) == want, piece


def test_long_texts_are_cut_into_slices_of_pieces():
    splitter = bytebpe.worker_tools(PATH, P.PATTERN)[0]
    for text in ("", "a  b c\n", "one two, 3 " * 50, "\u0558x \U000323b0 y" * 9):
        for size in (1, 3, 1000):
            parts = list(splitter.slices(text, size))
            assert [p for part in parts for p in part] == splitter.pieces(text)
            assert all(0 < len(part) <= size for part in parts)


def test_long_pieces_take_linear_work():
    encoder = bytebpe.worker_tools(PATH, P.PATTERN)[1]
    plain = reference(PATH)
    long = "a" * 30_000
    assert encoder.ids(long.encode()) == plain.encode_ordinary(long)
    assert len(encoder.ids(b"ab" * 500_000)) > 1000          # quadratic work would not end


def test_memory_of_pieces_is_bounded():
    encoder = bytebpe.BytePairEncoder(bytebpe.read_ranks(PATH), max_pieces=50)
    for i in range(40):
        encoder.packed([f"w{i}x{j}" for j in range(20)])
    assert len(encoder.memory) <= 70 and len(encoder.memory.older) <= 70


def test_odd_documents(spark):
    ship(spark)
    texts = ["", None, " ", "a  b", "<|endoftext|>", "x" * 300_000, "word " * 250_000, "é͸ß"]
    rows = [(i, t, 1, "y") for i, t in enumerate(texts)] + [(None, "no id", 1, "y"), (3, "a  b", 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, n_tokens string")
    plain = reference(PATH)
    for frame, want in ((docs, rows), (docs.limit(0), [])):
        out = bytebpe.decode(bytebpe.encode(frame, PATH, P.PATTERN), PATH, P.PATTERN).collect()
        assert sorted((str(r.doc_id), r.n_tokens, bytes(r.ids)) for r in out) == sorted(
            (str(i), len(ids), np.array(ids, "<u4").tobytes()) for i, ids in
            ((i, plain.encode_ordinary(t or "")) for i, t, *_ in want))
        assert all(bytes(r.decoded) == plain.decode_bytes(np.frombuffer(r.ids, "<u4").tolist())
                   and r.n_bytes == len(r.decoded) for r in out)


def test_query(spark):
    plain = reference(PATH)
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = set()
    for r in rows:
        ids = plain.encode_ordinary(r.text or "")
        # The pattern's matches cover every text, so decoding gives the text back.
        assert "".join(regex.findall(P.PATTERN, r.text or "")) == (r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op12_byte_bpe"](spark, SMALL).collect()} == want
