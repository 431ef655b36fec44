"""Keyed tokens and their vault (R7): pseudonyms that only a key holder can make or undo.

A token is the HMAC-SHA256 of a value under a secret key, so values in a small range
can't be found by trying them, as they can with a salted hash.  The vault is a table of
(key id, token, value) which takes only values it has not seen; with it tokens are undone,
or renewed under another key, without the table they were taken from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, remove_path
from .joins import lookup_join

BLOCK = 64          # bytes of SHA-256's block, by which HMAC pads its key
VAULT = "token string, value string, key_id string"
SETTING = "ingot.token.key."


def session_key(spark: SparkSession, key_id: str) -> bytes:
    """The key a session holds under ``ingot.token.key.<key id>`` (hexadecimal, 16 bytes or more)."""
    key = bytes.fromhex(spark.conf.get(SETTING + key_id))
    if len(key) < 16:
        raise ValueError("a token key has at least 16 bytes")
    return key


def keyed_hash(spark: SparkSession, value: Column, key: bytes) -> Column:
    """HMAC-SHA256 (hex) of a value's text; null for null.

    The padded keys come from a one-row relation, since a literal would show in plans."""
    if len(key) > BLOCK:
        raise ValueError(f"a key has at most {BLOCK} bytes")
    padded = key.ljust(BLOCK, b"\0")
    pads = spark.createDataFrame([(bytearray(b ^ 0x36 for b in padded),
                                   bytearray(b ^ 0x5C for b in padded))], "inner binary, outer binary")
    inner, outer = pads.select("inner").scalar(), pads.select("outer").scalar()
    first = F.sha2(F.concat(inner, value.cast("string").cast("binary")), 256)
    return F.sha2(F.concat(outer, F.unhex(first)), 256)


def tokenize_keyed(df: DataFrame, columns: list[str], key: bytes, suffix: str = "_token") -> DataFrame:
    """Replace identifiers by keyed tokens; equal values get equal tokens in every table."""
    spark = df.sparkSession
    return df.withColumns({c + suffix: keyed_hash(spark, F.col(c), key) for c in columns}).drop(*columns)


def read_vault(spark: SparkSession, vault: str, key_id: str) -> DataFrame:
    """``token, value`` of one key; only its directory is read."""
    return spark.read.schema(VAULT).parquet(vault).where(F.col("key_id") == key_id).select(
        "token", "value")


def enroll(values: DataFrame, column: str, vault: str, key: bytes, key_id: str) -> None:
    """Add the values the vault does not hold under this key (one row each; nulls never).

    A value's copies collapse map-side; what is there already goes by an anti-join on the
    token, so running it again adds nothing."""
    spark = values.sparkSession
    text = values.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()
    rows = text.withColumn("token", keyed_hash(spark, F.col("value"), key))
    if path_exists(spark, vault):
        rows = rows.join(read_vault(spark, vault, key_id).select("token"), "token", "left_anti")
    rows.withColumn("key_id", F.lit(key_id)).select("token", "value", "key_id").write.mode(
        "append").partitionBy("key_id").parquet(vault)


def reidentify(df: DataFrame, column: str, vault: str, key_id: str, out: str = "value") -> DataFrame:
    """``df`` with the value behind each token of ``column`` (null if the vault has none)."""
    known = read_vault(df.sparkSession, vault, key_id).select(
        F.col("token").alias(column), F.col("value").alias(out))
    return lookup_join(df, known, column, "left")


def rotate(df: DataFrame, column: str, vault: str, old_id: str, new_key: bytes, new_id: str) -> DataFrame:
    """``df`` with tokens of a new key in place of the old one's, by way of the vault.

    The new tokens are enrolled first.  A token the vault does not hold is an error that shows
    when the rows are computed, so no row silently keeps or loses its token."""
    spark = df.sparkSession
    enroll(read_vault(spark, vault, old_id), "value", vault, new_key, new_id)
    old, new = read_vault(spark, vault, old_id), read_vault(spark, vault, new_id)
    pairs = old.join(new.withColumnRenamed("token", "_new"), "value").select(
        F.col("token").alias(column), "_new")
    found = lookup_join(df, pairs, column, "left")
    renewed = F.when(F.col(column).isNull(), F.lit(None).cast("string")).when(
        F.col("_new").isNull(), F.raise_error(F.lit("a token is not in the vault"))).otherwise(F.col("_new"))
    return found.withColumn(column, renewed).select(df.columns)


def retire(spark: SparkSession, vault: str, key_id: str) -> None:
    """Forget a key's tokens, once no table holds them."""
    remove_path(spark, f"{vault.rstrip('/')}/key_id={key_id}")
