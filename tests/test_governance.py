"""Keyed tokens and their vault; k-anonymity by generalising."""

import hashlib
import hmac
import os
import random

import pytest
from pyspark.sql import functions as F

from ingot.operators import mondrian as M
from ingot.operators import vault as V
from ingot.session import fresh_path

KEY, OTHER = b"0123456789abcdef-one", b"0123456789abcdef-two"


def plain(value, key=KEY):
    return hmac.new(key, str(value).encode(), hashlib.sha256).hexdigest()


def test_tokens_are_hmacs(spark):
    df = spark.createDataFrame([(1, "é"), (2, None), (3, "")], "n int, s string")
    rows = V.tokenize_keyed(df, ["n", "s"], KEY).collect()
    assert [r.n_token for r in rows] == [plain(i) for i in (1, 2, 3)]
    assert [r.s_token for r in rows] == [plain("é"), None, plain("")]
    for key in (b"k" * 64, b"k" * 17):
        assert V.tokenize_keyed(df, ["n"], key).first().n_token == plain(1, key)
    with pytest.raises(ValueError, match="64"):
        V.tokenize_keyed(df, ["n"], b"k" * 65)


def test_the_key_shows_in_no_plan(spark):
    df = V.tokenize_keyed(spark.createDataFrame([("a",)], "s string"), ["s"], KEY)
    df.collect()
    plan = df._jdf.queryExecution().toString()
    pads = [bytes(b ^ x for b in KEY.ljust(64, b"\0")) for x in (0, 0x36, 0x5C)]
    for pad in pads:
        assert pad[:8].hex().upper() not in plan.upper() and pad[:8].decode("latin-1") not in plan


def test_a_session_key_is_hexadecimal_and_long_enough(spark):
    spark.conf.set(V.SETTING + "t", KEY.hex())
    assert V.session_key(spark, "t") == KEY
    spark.conf.set(V.SETTING + "t", "00")
    with pytest.raises(ValueError, match="16"):
        V.session_key(spark, "t")


def test_the_vault_takes_only_what_it_has_not_seen(spark):
    vault = fresh_path(spark, "g-vault")
    for names in (["a", "b", "a", None], ["b", "c"], ["a", "b", "c"], []):
        V.enroll(spark.createDataFrame([(n,) for n in names], "s string"), "s", vault, KEY, "k1")
    rows = V.read_vault(spark, vault, "k1").collect()
    assert sorted(map(tuple, rows)) == sorted((plain(n), n) for n in "abc")


def test_rotation_and_back(spark):
    vault = fresh_path(spark, "g-rotate")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, s string")
    V.enroll(df, "s", vault, KEY, "k1")
    old = V.tokenize_keyed(df, ["s"], KEY)
    new = V.rotate(old, "s_token", vault, "k1", OTHER, "k2")
    assert {r.id: r.s_token for r in new.collect()} == {
        1: plain("a", OTHER), 2: plain("b", OTHER), 3: plain("a", OTHER), 4: None}
    assert new.columns == old.columns
    back = V.reidentify(new, "s_token", vault, "k2", "s").collect()
    assert {r.id: r.s for r in back} == {1: "a", 2: "b", 3: "a", 4: None}
    V.retire(spark, vault, "k1")
    assert [n for n in os.listdir(vault.removeprefix("file://").removeprefix("file:"))
            if n.startswith("key_id")] == ["key_id=k2"]
    assert V.reidentify(old, "s_token", vault, "k1", "s").where("s IS NOT NULL").count() == 0


def test_a_token_the_vault_does_not_hold_stops_the_rotation(spark):
    vault = fresh_path(spark, "g-lost")
    V.enroll(spark.createDataFrame([("a",)], "s string"), "s", vault, KEY, "k1")
    lost = spark.createDataFrame([(plain("z"),)], "s_token string")
    with pytest.raises(Exception, match="not in the vault"):
        V.rotate(lost, "s_token", vault, "k1", OTHER, "k2").collect()


# k-anonymity

def classes_of(rows, quasi):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[f"{q}_{e}"] for q in quasi for e in ("low", "high")), []).append(r)
    return out


@pytest.mark.parametrize("k", [1, 3, 10])
def test_every_class_is_large_and_every_row_stays(spark, k):
    rng = random.Random(k)
    rows = [(i, rng.gauss(0, 100), rng.randrange(20), rng.choice(["x", "y"])) for i in range(300)]
    rows += [(1000 + i, 5.0, 7, "hot") for i in range(150)]           # a third is one value
    df = spark.createDataFrame(rows, "id int, a double, b int, other string").withColumns(
        {"own_a": F.col("a"), "own_b": F.col("b")})
    out = M.generalize_to_classes(df, ["a", "b"], k, bins=64).collect()
    assert sorted(r.id for r in out) == sorted(r[0] for r in rows)
    classes = classes_of(out, ["a", "b"])
    assert all(len(own) >= k and {r.class_size for r in own} == {len(own)} for own in classes.values())
    assert all(r.a_low <= r.own_a <= r.a_high and r.b_low <= r.own_b <= r.b_high for r in out)
    assert len(classes) > 300 / (8 * k)                               # cut as far as it goes
    assert "other" in out[0].asDict() and "a" not in out[0].asDict()


def test_few_rows_nulls_and_none(spark):
    rows = [(1, None, 1), (2, None, None), (3, 4.0, 2), (4, 5.0, 9)]
    df = spark.createDataFrame(rows, "id int, a double, b int")
    one = M.generalize_to_classes(df, ["a", "b"], 10).collect()
    assert {(r.a_low, r.a_high, r.b_low, r.b_high, r.class_size) for r in one} == {(4.0, 5.0, 1, 9, 4)}
    two = M.generalize_to_classes(df, ["a", "b"], 2).collect()
    assert sorted(r.id for r in two) == [1, 2, 3, 4] and {r.class_size for r in two} == {2}
    assert M.generalize_to_classes(df.limit(0), ["a", "b"], 2).count() == 0
    with pytest.raises(ValueError, match="positive"):
        M.generalize_to_classes(df, ["a"], 0)
