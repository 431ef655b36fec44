"""Governance queries on ``customer``: generalisation, suppression,
k-anonymity, tokenisation (R4-R7).  Retention (R3) is in ``plans.bronze``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import oracle_governance as O
from ..operators import mondrian as M
from ..operators import privacy as P
from ..operators import vault as V
from ..registry import query
from ..session import fresh_path
from ..sources.tables import read_table

BALANCE_BAND = 1000                       # generalize: account balance band width
QUASI = ["c_nationkey", "c_mktsegment"]   # k_anonymity: quasi-identifiers
K = 10                                    # k_anonymity: minimum group size
TOKEN_SALT = "ingot-salt-v1"              # tokenize: fixed salt of the test


@query("generalize", O.GENERALIZE)
def q_generalize(spark: SparkSession, sf_dir: str):
    c = read_table(spark, sf_dir, "customer")
    return P.generalize(c.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"),
                        {"c_acctbal": BALANCE_BAND})


@query("suppress", O.SUPPRESS)
def q_suppress(spark: SparkSession, sf_dir: str):
    c = read_table(spark, sf_dir, "customer")
    out = P.suppress(c, ["c_name"])
    return P.suppress(out, ["c_acctbal"], when=F.col("c_acctbal") < 0)


@query("k_anonymity", O.K_ANONYMITY)
def q_k_anonymity(spark: SparkSession, sf_dir: str):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", *QUASI)
    return P.k_anonymous(c, QUASI, K)


@query("tokenize", O.TOKENIZE)
def q_tokenize(spark: SparkSession, sf_dir: str):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return P.tokenize(c, ["c_name"], TOKEN_SALT)


KEYS = {"k1": b"ingot-test-key-number-one", "k2": b"ingot-test-key-number-two"}  # of the test


@query("token_vault", O.TOKEN_VAULT)
def q_token_vault(spark: SparkSession, sf_dir: str):
    """R7 with a key: names become tokens and enter the vault (every order's customer again, to
    no effect), the key is rotated, and a holder of the vault gets the names back."""
    vault = fresh_path(spark, "vault")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for values in (c, c.unionByName(c)):
        V.enroll(values, "c_name", vault, KEYS["k1"], "k1")
    named = V.tokenize_keyed(c.withColumn("name", F.col("c_name")), ["c_name"], KEYS["k1"])
    first = named.drop("name").withColumn("first", F.col("c_name_token"))
    second = V.rotate(first, "c_name_token", vault, "k1", KEYS["k2"], "k2")
    size = V.read_vault(spark, vault, "k2").count()
    back = V.reidentify(second, "c_name_token", vault, "k2", "c_name")
    return back.select("c_custkey", "c_name", (F.col("first") != F.col("c_name_token"))
                       .alias("renewed"), F.lit(size).cast("long").alias("vault_size"))


@query("k_anonymity_classes", O.K_ANONYMITY_CLASSES)
def q_k_anonymity_classes(spark: SparkSession, sf_dir: str):
    """R4 + R6: balances and nations as ranges of classes of ``K`` customers or more.  A row per
    customer: whether its class is large enough and holds its values."""
    quasi = ["c_acctbal", "c_nationkey"]
    c = read_table(spark, sf_dir, "customer").select("c_custkey", *quasi)
    held = M.generalize_to_classes(c.withColumns({f"own_{q}": F.col(q) for q in quasi}), quasi, K)
    inside = [F.col(f"own_{q}").between(F.col(f"{q}_low"), F.col(f"{q}_high")) for q in quasi]
    size = F.count(F.lit(1)).alias("rows")
    classes = held.groupBy(*(f"{q}_{e}" for q in quasi for e in ("low", "high")), "class_size").agg(size)
    cut = classes.count() > 1
    return held.select("c_custkey", *(f"own_{q}" for q in quasi), (F.col("class_size") >= K)
                       .alias("large"), (inside[0] & inside[1]).alias("inside"),
                       F.lit(cut).alias("several"))
