"""The enrichment hops as checkpointed streams.

    seeds topic --hop 1 (identity, latest-n history)--> details topic
    details topic --hop 2 (documents)--> matchs topic

Each hop consumes JSON messages, looks its rows up, and writes three results of
one pass: the next topic, the retry table (what a lookup did not know, with the
reason) and the quarantine (what did not parse, was null or blank).  No message
vanishes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import message_key, message_text, parse_once, to_message
from ..functions.schemas import DETAIL_SCHEMA, SEED_SCHEMA
from ..operators import enrich as E
from ..operators.bronze import CORRUPT, load_date
from .ingest import Output, run_split
from .ledger import Batch


WIDE_ROWS_PER_FILE = 25_000         # messages with a document: 50 to 60 MB of text


def as_topic(rows: DataFrame, key: str) -> DataFrame:
    """Rows as ``(key, value)`` JSON messages, both as bytes."""
    return rows.select(message_key(key).alias("key"),
                       to_message(*rows.columns).cast("binary").alias("value"))


def consume(messages: DataFrame, schema: StructType) -> DataFrame:
    """Messages -> their fields, ``_bad``, and the text of bad ones; each is parsed once."""
    parsed = parse_once(messages.select(message_text().alias("_raw")), "_raw", schema, "_m", CORRUPT)
    bad = F.col("_m")[CORRUPT].isNotNull() | F.coalesce(F.trim("_raw") == "", F.lit(True))
    return parsed.select(*[F.col("_m")[f].alias(f) for f in schema.names],
                         F.when(bad, F.col("_raw")).alias("_raw"), bad.alias("_bad"))


Lookup = DataFrame | Callable[[], DataFrame]


def _now(lookup: Lookup) -> DataFrame:
    """The lookup as it is now: a function is asked anew for every micro-batch."""
    return lookup if isinstance(lookup, DataFrame) else lookup()


def _hop(messages: DataFrame, mark: Callable[[DataFrame], DataFrame], topic: Output | str,
         retry: str, quarantine: str, checkpoint: str, partition_date,
         extend: Callable[[DataFrame], DataFrame] | None = None, **options):
    """``mark`` looks a micro-batch's rows up.  Bad messages ride along (left joins keep them)
    and are told apart by ``_bad``.  ``extend`` looks up what only the topic takes."""
    if isinstance(topic, str):
        topic = Output(lambda b: b.rows, topic, "files")

    def day(b: Batch):
        return load_date(b.day if partition_date is None else partition_date)

    def good(b: Batch) -> DataFrame:
        return b.rows.where("NOT _bad")
    return run_split(messages, [
        Output(lambda b: as_topic(E.enriched(good(b)), "match_id"), topic.path, topic.fmt,
               topic.options, extend=extend, rows_per_file=extend and WIDE_ROWS_PER_FILE),
        Output(lambda b: E.retries(good(b)).withColumn("partition_date", day(b)), retry),
        Output(lambda b: b.rows.where("_bad").select(F.col("_raw").alias("raw_message"),
                                                     day(b).alias("partition_date")), quarantine)],
        checkpoint, prepare=lambda b: mark(b.rows), **options)


def enrich_details(messages: DataFrame, identity: Lookup, lists: Lookup, processed_at,
                   topic: Output | str, retry: str, quarantine: str, checkpoint: str,
                   partition_date=None, **options):
    """Hop 1: seed messages -> one detail message per recent match.

    Lookups given as functions are resolved by each micro-batch, so a refresh between two
    batches is seen by the second."""
    return _hop(consume(messages, SEED_SCHEMA), lambda rows: E.mark_history(
        rows, _now(identity), _now(lists), processed_at, keep=("_raw", "_bad")),
        topic, retry, quarantine, checkpoint, partition_date, **options)


def enrich_matches(messages: DataFrame, documents: Lookup, fetched_at, topic: Output | str,
                   retry: str, quarantine: str, checkpoint: str, partition_date=None, **options):
    """Hop 2: detail messages -> match messages that carry the document.

    A micro-batch is marked by the lookup's match ids alone and kept without documents.  These
    are joined, from the same version of the lookup, to the rows that have one as the topic is
    written, so no document is kept, or shuffled again, on its way there."""
    found: dict[str, DataFrame] = {}

    def mark(rows: DataFrame) -> DataFrame:
        found["documents"] = _now(documents)
        known = found["documents"].select("match_id").distinct().withColumn(
            "match_details", F.lit(None).cast("string"))
        return E.mark_documents(rows, known, fetched_at).drop("timestamp_match", "match_details")

    def attach(rows: DataFrame) -> DataFrame:
        return E.mark_documents(rows.where("NOT _bad AND reason IS NULL"), found["documents"],
                                fetched_at)
    return _hop(consume(messages, DETAIL_SCHEMA), mark, topic, retry, quarantine, checkpoint,
                partition_date, extend=attach, **options)
