"""Prefix trie of conversations against sets of members built by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ingot.llm import prefixtrie
from ingot.llm.common import ship
from ingot.llm.prefixtrie import LOW, Skeleton, choose_splitters

TURNS = "conv_id long, turn long, role string, text string"
EXTRA = ", path string, sizes int, shard string, skeleton int, at long"


def by_hand(rows):
    """Nodes of the conversations as they stand."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: tuple((r, t) for _, _, r, t in sorted(own, key=lambda x: (x[0], x[1], hashlib.sha256(
        f"{len(x[2].encode())}:{x[2]}{x[3]}".encode()).digest()[:16]))) for c, own in convs.items()}
    return nodes_of(convs)


def nodes_of(convs):
    members = {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        size = len(node[-1][1]) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[k] for k in below)
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if convs[c] == node)
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
                    len(kids.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def by_spark(spark, rows, shards=None, extra=False):
    ship(spark)
    clash = ("p", 1, "s", 2, 3) if extra else ()
    df = spark.createDataFrame([(*r, *clash) for r in rows], TURNS + (EXTRA if extra else ""))
    out = prefixtrie.trie(prefixtrie.turn_paths(df), shards)
    assert out.columns == prefixtrie.NODE
    return sorted((tuple(r) for r in out.collect()), key=str)


def random_rows(seed, n, words="ab", most=6):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]) if t % 3 == 0 else "user", rng.choice(words) * (t + 1))
            for c in range(n) for t in range(rng.randint(0, most))]


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_random_conversations(spark, shards):
    rows = random_rows(shards, 150)
    assert by_spark(spark, rows, shards) == by_hand(rows)


def test_copies_of_one_conversation_spread_over_shards(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(4)]
    rows += random_rows(5, 60, "xyz")
    assert by_spark(spark, rows, 16) == by_hand(rows)
    paths = [(b"a" * 64, c, 4) for c in range(400)]
    cuts = choose_splitters(paths, 8)
    assert len(cuts) == 7 and all(path == b"a" * 64 and conv > LOW for path, conv in cuts)


def test_odd_turns_and_none(spark):
    long = "x" * 2_000_000
    rows = [(1, None, None, None), (1, 0, "user", ""), (2, None, "", None), (2, 0, "user", long),
            (3, 5, "user", "tie"), (3, 5, "bot", "tie"), (3, 5, "bot", "tie"), (4, 5, "bot", "tie"),
            (4, 5, "user", "tie"), (4, 5, "bot", "tie"), (None, 1, "user", "nobody"),
            (-7, 1, "é", "漢字"), (-7, 2, "a:", "b"), (-8, 1, "é", "漢字"), (-8, 2, "a", ":b")]
    assert by_spark(spark, rows, 5, extra=True) == by_hand(rows)
    assert by_spark(spark, []) == []


def test_long_conversations(spark):
    """Deeper than the beginnings that reach the driver, with copies."""
    rows = [(c, t, "user", str(t % 7) if t < 2990 + 3 * (c % 3) else f"{c % 3} {t}")
            for c in range(12) for t in range(3000)]
    assert by_spark(spark, rows, 6) == by_hand(rows)


def test_grafted_conversations(spark):
    rows = random_rows(8, 230, "abcd")
    ship(spark)
    paths = prefixtrie.turn_paths(spark.createDataFrame(rows, TURNS))
    own = F.col("conv_id")
    heads = paths.where(own % 100 == 0)
    got = prefixtrie.trie(prefixtrie.graft(paths, heads, own - own % 100, own % 6, 5), 7)
    convs = {}
    for c, _, role, text in rows:
        convs.setdefault(c, []).append((role, text))
    built = {c: tuple(convs.get(c - c % 100, [])[:c % 6] + own[c % 6:]) for c, own in convs.items()}
    assert sorted((tuple(r) for r in got.collect()), key=str) == nodes_of(built)
    assert () in built.values()


def test_every_node_across_a_splitter_is_in_the_skeleton():
    rng = random.Random(2)
    paths = sorted((b"".join(bytes([rng.randint(0, 2)]) * 16 for _ in range(rng.randint(0, 6))), c)
                   for c in range(500))
    cuts = choose_splitters([(p, c, len(p) // 16) for p, c in paths], 20)
    skeleton = Skeleton(cuts)
    assert cuts == sorted(set(cuts)) and 10 <= len(cuts) <= 19
    shards = {}
    for key in paths:
        at = sum(cut <= key for cut in cuts)
        for d in range(0, len(key[0]) + 1, 16):
            shards.setdefault(key[0][:d], set()).add(at)
    for node, own in shards.items():
        at = 0
        for lo in range(0, len(node), 16):
            at = skeleton.kids[at].get(node[lo:lo + 16], -1) if at >= 0 else -1
        assert len(own) == 1 or at >= 0
