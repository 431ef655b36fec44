"""Stage throughput while the stream runs (L9): closed minutes of an event-time aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import monitor as T
from ..operators.bronze import parse_envelope
from .ingest import Output, run_split


def follow_throughput(messages: DataFrame, sink: str, checkpoint: str, delay: str = "10 minutes",
                      **options):
    """Count the messages of a topic per minute and stage, and land each minute once.

    A minute's row is written when the watermark has passed it (see ``closed_minutes``), to
    ``sink`` by the minute's date and the micro-batch; a repeated micro-batch replaces its
    own rows.  The state holds the open minutes only and survives a restart in the
    checkpoint.  Bad messages have no stage time and count nowhere.  A batch's closed
    minutes, one small row each, are written as one file per date.
    """
    rows = parse_envelope(messages).where(~F.col("_bad"))
    closed = T.closed_minutes(rows, delay)
    return run_split(closed, [Output(lambda b: b.rows.repartition(1).withColumn(
        "partition_date", F.to_date("minute")), sink)], checkpoint, **options)
