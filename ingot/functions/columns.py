"""Column-level helpers: time text, JSON parsing, message values.

All are built-in Spark expressions (JVM side, inside whole-stage codegen); no
Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fixed format: naive UTC ISO text with microseconds, as the producers write it.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
MINUTE_PATTERN = "yyyy-MM-dd HH:mm"

# JSON text keeps full microsecond precision both ways (Spark's defaults write
# milliseconds only, so a round trip would lose the fraction's last digits).
JSON_TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                     "timestampNTZFormat": ISO_PATTERN}


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_text(ts) -> Column:
    """Timestamp -> naive ISO text (the producers' ``isoformat()``)."""
    return F.date_format(col_(ts), ISO_PATTERN)


def stage_time(text) -> Column:
    """Stage text -> ``timestamp_ntz``; null for null or malformed text.

    A plain cast or ``date_format`` over bad text raises under ANSI mode (the
    Spark 4 default); ``try_cast`` yields null instead.  The result is
    zone-free, so the minute it falls in does not depend on the session zone.
    """
    return col_(text).try_cast("timestamp_ntz")


def minute_of(text) -> Column:
    """The minute a stage text falls in, as ``timestamp_ntz``."""
    return F.date_trunc("minute", stage_time(text)).cast("timestamp_ntz")


def epoch_millis(ts) -> Column:
    """Zone-free epoch milliseconds of a ``timestamp_ntz`` column."""
    return F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {})"
                  .format(_sql(ts)))


def seconds_between(start, end) -> Column:
    """Seconds from ``start`` to ``end`` with microsecond precision (double)."""
    return F.expr("timestampdiff(MICROSECOND, {}, {})".format(_sql(start), _sql(end))) / 1e6


def add_seconds(ts, seconds) -> Column:
    return F.timestamp_add("SECOND", col_(seconds), col_(ts))


def parse_json(text, schema: StructType, corrupt_column: str | None = None) -> Column:
    """``from_json`` with a fixed schema (PERMISSIVE).

    With ``corrupt_column`` the schema gains that string field and Spark puts
    the raw text of any record it could not parse fully there (quarantine).
    """
    if corrupt_column is None:
        return F.from_json(col_(text), schema, JSON_TIME_OPTIONS)
    full = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
    return F.from_json(col_(text), full, {**JSON_TIME_OPTIONS,
                                          "columnNameOfCorruptRecord": corrupt_column})


def parse_once(df: DataFrame, text, schema: StructType, out: str,
               corrupt_column: str | None = None) -> DataFrame:
    """``df`` with the parsed record in ``out``, parsed exactly once per row.

    A filter or key on a parsed field would be pushed below a plain projection,
    and the text parsed again for it.  A one-element ``inline`` stands between:
    nothing is pushed below a generator's output, and the outer form keeps
    Spark from inferring a filter on it.
    """
    parsed = parse_json(text, schema, corrupt_column)
    return df.select("*", F.inline_outer(F.array(F.struct(parsed.alias(out)))))


def message_text(value="value") -> Column:
    """Message bytes -> text (the bus carries UTF-8 JSON)."""
    return col_(value).cast("string")


def message_key(key) -> Column:
    """A message's key as a topic takes it: the bytes of its text (null: none)."""
    return col_(key).cast("string").cast("binary")


def to_message(*cols) -> Column:
    """A record as one JSON message value (what a producer publishes)."""
    return F.to_json(F.struct(*cols), JSON_TIME_OPTIONS)


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")
