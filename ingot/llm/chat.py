"""Multi-party perspective rotation of dialogues, in DataFrame operations only.

Every participant's view renders the whole dialogue with that participant as the
assistant and the others as named users.  A view is a sequence of rendered
turns; each carries the span of its own text and a mask that is 1 on the
assistant's words.  ``text`` of a view's rows, joined in order, is the rendered
dialogue, and ``start`` is the turn's place in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import numbered

BUCKET = 256                       # turns whose running length one window adds up
SALTS = 64                         # rows which the copies of one turn are counted in, at most
PREFIX = 64                        # characters of a turn's words that order the range shuffle


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """``conv_id, speaker, turn, author, role, text, start, mask_start, mask_end, masked``.

    One row per dialogue, participant and turn.  ``role`` is "assistant" for the
    participant's own turns and "user" for others'; users are named in the header.
    A dialogue is its rows in the order of turn, author, text (nulls first).  A row
    without a conversation id belongs to no dialogue and leaves; a null role is the
    participant "unknown"; a null text is empty.  A repeated row is a turn of its own.
    ``mask_start`` and ``mask_end`` bound the turn's own words within the rendered
    dialogue (characters, end exclusive), and ``masked`` is 1 where the participant
    learns from them.  Texts of any length are rendered whole.  Empty tables give no rows;
    other columns are ignored.

    Rows are numbered within their dialogue by a range shuffle, whatever their turns say, and
    running lengths are added up in buckets of ``BUCKET`` of them and then over bucket
    totals, so a dialogue that holds a third of all rows, with its turns all null or
    equal, is not one task's work.  Copies of one turn are counted in ``SALTS`` rows.
    """
    raw = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("author"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("words"))
    # Participants: the distinct authors of a dialogue.
    speakers = raw.select("conv_id", F.col("author").alias("speaker")).distinct()
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS))
    grouped = raw.withColumn("salt", salt).groupBy("conv_id", "turn", "author", "words", "salt").agg(
        F.count("*").alias("copies")).withColumn("prefix", F.substring("words", 1, PREFIX))
    placed = numbered(grouped, "conv_id", ["conv_id", "turn", "author", "prefix", "salt"],
                      fresh_path(turns.sparkSession, "turns"), ["words"])
    view = placed.join(speakers, "conv_id")
    own = F.col("author") == F.col("speaker")
    head = F.when(own, F.lit("<|assistant|>\n")).otherwise(
        F.concat(F.lit("<|user name="), "author", F.lit("|>\n")))
    view = view.select(
        "conv_id", "speaker", "turn", "author", F.when(own, "assistant").otherwise("user")
        .alias("role"), F.concat(head, "words", F.lit("<|end|>\n")).alias("text"),
        F.length(head).alias("head"), F.length("words").alias("size"), own.cast("int")
        .alias("masked"), "copies", "place", F.floor(F.col("place") / BUCKET).alias("bucket"))
    length = F.length("text") * F.col("copies")
    keys = ["conv_id", "speaker"]
    inner = Window.partitionBy(*keys, "bucket").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = view.groupBy(*keys, "bucket").agg(F.sum(length).alias("total"))
    outer = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*keys, "bucket", F.coalesce(F.sum("total").over(outer), F.lit(0))
                          .alias("base"))
    laid = view.withColumn("inside", F.coalesce(F.sum(length).over(inner), F.lit(0))).join(
        bases, [*keys, "bucket"])
    each = laid.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1)
                                                          .cast("int"))))
    start = F.col("base") + F.col("inside") + F.col("copy") * F.length("text")
    return each.select(
        "conv_id", "speaker", "turn", "author", "role", "text", start.alias("start"),
        (start + F.col("head")).alias("mask_start"),
        (start + F.col("head") + F.col("size")).alias("mask_end"), "masked")
