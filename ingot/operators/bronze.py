"""Bronze operators: raw messages -> the landed ``matchs`` table (L1).

Batch and streaming share these functions; only the source and sink differ.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import message_text, parse_once
from ..functions.schemas import BRONZE_COLUMNS, ENVELOPE_SCHEMA

CORRUPT = "_corrupt_record"


def load_date(partition_date=None):
    """The bronze load date: an explicit date (reruns, tests), a column
    expression (e.g. the event's own date), or ``current_date()``."""
    if partition_date is None:
        return F.current_date()
    if isinstance(partition_date, Column):
        return partition_date
    if not isinstance(partition_date, dt.date):
        partition_date = dt.date.fromisoformat(str(partition_date))
    return F.lit(partition_date)


def parse_envelope(messages: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """Message bytes -> envelope columns plus ``_raw`` (the text) and ``_bad``.

    The parse is PERMISSIVE with a corrupt-record column, so a garbage message
    never fails the batch.  A message is bad if it does not parse, is null, or is
    blank; an object without any known field is not.  ``match_details`` is
    declared a string, so a nested object arrives as its raw JSON text (quirk
    Q1).  Each message is parsed once.
    """
    text = messages.select(*keep, message_text(value).alias("_raw"))
    parsed = parse_once(text, "_raw", ENVELOPE_SCHEMA, "_data", CORRUPT)
    bad = F.col("_data")[CORRUPT].isNotNull() | F.coalesce(F.trim("_raw") == "", F.lit(True))
    return parsed.select(*keep, *[F.col("_data")[f].alias(f) for f in ENVELOPE_SCHEMA.names],
                         "_raw", bad.alias("_bad"))


def to_bronze(envelopes: DataFrame, partition_date=None, keep=()) -> DataFrame:
    """Valid envelopes -> bronze rows stamped with their load date."""
    return (envelopes.where(~F.col("_bad"))
            .withColumn("partition_date", load_date(partition_date))
            .select(*keep, *BRONZE_COLUMNS))


def quarantined(envelopes: DataFrame, partition_date=None, keep=()) -> DataFrame:
    """Bad messages with their raw text (null for a null message) and load date."""
    return (envelopes.where(F.col("_bad"))
            .select(*keep, F.col("_raw").alias("raw_message"),
                    load_date(partition_date).alias("partition_date")))


def bronze_ingest(messages: DataFrame, partition_date=None, keep=()) -> DataFrame:
    return to_bronze(parse_envelope(messages, keep=keep), partition_date, keep)
