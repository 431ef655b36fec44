"""Merkle manifest against a tree built by hand."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ingot.llm import merkle
from ingot.session import fresh_path

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
EXTRA = ", digest string, parent int, grp long, place string, path binary, node int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    tree = [nodes]
    while len(tree[-1]) > 1:
        tree.append([sha("".join(tree[-1][i:i + 3])) for i in range(0, len(tree[-1]), 3)])
    return tree


def path_of(tree, at):
    path = []
    for level in tree[:-1]:
        run = at - at % 3
        path.append(("".join(level[run:at]), "".join(level[at + 1:run + 3])))
        at //= 3
    return path


def by_hand(rows):
    """Sorted tuples of the query's columns."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = levels_of([leaf_of(r) for r in groups[s]])
    upper = levels_of([trees[s][-1][0] for s in order])
    root, out = upper[-1][0], []
    for k, s in enumerate(order):
        for at, row in enumerate(groups[s]):
            path = path_of(trees[s], at) + path_of(upper, k)
            even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            text = row[4].replace("\n", "") if even and row[4] is not None else row[4]
            folded = leaf_of((*row[:4], text))
            for before, after in path:
                folded = sha(before + folded + after)
            out.append((row[0], leaf_of(row), trees[s][-1][0], root,
                        sha("".join(b + a for b, a in path)), folded, folded == root))
    return sorted(out, key=str)


def by_spark(spark, rows, extra=True):
    clash = ("x", 1, 2, "p", b"q", 3) if extra else ()
    docs = spark.createDataFrame([(*r, *clash) for r in rows], SCHEMA + (EXTRA if extra else ""))
    even = F.crc32(docs.doc_id.cast("string").cast("binary")) % 2 == 0
    claim = [F.when(even, F.replace(docs.text, F.lit("\n"), F.lit(""))).otherwise(docs.text)
             if c == "text" else docs[c] for c in FIELDS]
    path = fresh_path(spark, "t-manifest")
    merkle.build(docs, FIELDS, path, claim=claim)
    return sorted((
        (r.doc_id, r.leaf.hex(), r.subroot.hex(), r.root.hex(),
         hashlib.sha256(r.siblings.hex().encode()).hexdigest(), r.folded_root.hex(), r.verified)
        for r in merkle.prove(spark, path).collect()), key=str)


def rows_of(n, sources, seed=3):
    rng = random.Random(seed)
    return [(i, rng.choice(sources), rng.choice(["en", None]), i % 7, "a\nb " * (i % 3))
            for i in range(n)]


@pytest.mark.parametrize("step", [1, 2, 6])
def test_manifest_of_uneven_sources(spark, monkeypatch, step):
    monkeypatch.setattr(merkle, "LEVELS", step)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** step)
    rows = rows_of(70, ["hot", "hot", "hot", None, "", "é", "z"])
    rows += [(500 + i, f"one{i}", None, None, "x\n") for i in range(11)]
    assert by_spark(spark, rows) == by_hand(rows)


def test_a_source_of_more_than_one_block(spark):
    rows = rows_of(merkle.BLOCK * 2 + 100, ["hot"]) + rows_of(5, ["a", "b"], 4)
    assert by_spark(spark, rows, extra=False) == by_hand(rows)


def test_odd_rows_and_none(spark):
    long = "many words\n" * 300_000
    rows = [(None, None, None, None, None), (1, "s", "en", 0, ""), (1, "s", "en", 0, ""),
            (1, "s", "en", 0, None), (2, "s", "de", 5, long), (3, None, None, None, "\n")]
    assert by_spark(spark, rows) == by_hand(rows)
    assert by_spark(spark, []) == []
    assert by_spark(spark, rows[:1]) == by_hand(rows[:1])
    assert spark.conf.get(merkle.ROW_LIMIT) == "1000000"


def test_a_changed_text_alone_fails(spark):
    rows = rows_of(40, ["s", "t"])
    for r, want in zip(by_spark(spark, rows), by_hand(rows), strict=True):
        assert r == want
        text = {i: t for i, *_, t in rows}[r[0]]
        changed = zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in text
        assert r[-1] is not changed
