"""What a micro-batch was given when it first ran, kept for when it runs again.

A batch that fails after some of its outputs is run again by Spark with the same rows, but
perhaps on another day.  Its load date, and the newest event time of the batches before
it, are therefore written to the ledger before its first output, and read from there when
it is repeated: it then replaces its own rows in every output.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import list_names, read_text, remove_path, write_text

KEPT = 100          # entries, as many as Spark keeps of its own log


@dataclass(frozen=True)
class Batch:
    """A micro-batch: its rows, its name (query and number), its load date, and the newest
    event time of all batches before it and up to it (None: none, or not asked for)."""

    rows: DataFrame
    tag: str
    day: dt.date
    before: dt.datetime | None = None
    newest: dt.datetime | None = None


def _text(t: dt.datetime | None) -> str | None:
    return t and t.isoformat()


def _time(text: str | None) -> dt.datetime | None:
    return text and dt.datetime.fromisoformat(text)


def today(spark: SparkSession) -> dt.date:
    return spark.sql("SELECT current_date() AS d").first()["d"]


def enter(spark: SparkSession, checkpoint: str, query: str, number: int,
          newest: Callable[[], dt.datetime | None],
          ) -> tuple[dt.date, dt.datetime | None, dt.datetime | None]:
    """(load date, newest event time before, and with it) of a batch, written when it is first
    seen.

    ``newest`` gives the batch's own newest event time; the entry carries the newest so
    far on to the next batch, so no entry but the last is ever read.
    """
    root = f"{checkpoint.rstrip('/')}/ledger"
    path = f"{root}/{query}-{number:08d}"
    entry = read_text(spark, path)
    if entry is None:
        last = read_text(spark, f"{root}/{query}-{number - 1:08d}") if number else None
        before = _time(json.loads(last)["newest"]) if last else None
        own = newest()
        entry = json.dumps({"day": today(spark).isoformat(), "before": _text(before),
                            "newest": _text(max(filter(None, (before, own)), default=None))})
        write_text(spark, path, entry)
        entry = read_text(spark, path)
        for name in list_names(spark, root):
            if name < f"{query}-{max(0, number - KEPT):08d}" and name.startswith(query):
                remove_path(spark, f"{root}/{name}")
    found = json.loads(entry)
    return dt.date.fromisoformat(found["day"]), _time(found["before"]), _time(found["newest"])
