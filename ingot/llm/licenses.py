"""Licence lookup by canonical digests, in DataFrame operations only.

A text is brought to a canonical form (case, punctuation, white space,
copyright lines, equivalent spellings) and hashed; the hash is joined with the
digests of known licence texts, which go through the same form.  Two kinds of
entire texts are looked up: the whole document, and each of its lines, where a
licence notice stands by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written
from .known_licenses import NOTICES, TEXTS, system_texts, titled

# Spellings that mean the same.
SPELLINGS = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"),
             ("sublicence", "sublicense"),
             ("https", "http"), ("noncommercial", "non commercial"),
             ("organisation", "organization"), ("whilst", "while"), ("ver", "version"),
             ("v", "version"), ("gnu general public license", "gnu gpl"), ("gpl", "gnu gpl"),
             ("gnu gnu gpl", "gnu gpl"))
# Lines that say whose copyright it is: with a year or sign, or with capitalised names only.
COPYRIGHT_LINE = (r"(?im)^[^\p{L}\p{N}\n]*(copyright\b|\(c\)|©)[^\n]*(\d{4}|\(c\)|©|<year>|by)[^\n]*$"
                  r"|^[^\p{L}\p{N}\n]*copyright([ \t]+(?-i:[A-Z]\.|[A-Z]\p{Ll}[\p{L}.'-]*),?){1,6}"
                  r"[^\p{L}\p{N}\n]*$"
                  r"|^[^\p{L}\p{N}\n]*all[ \t]+rights[ \t]+reserved[^\p{L}\p{N}\n]*$")
WHOLE, LINES = r"[^\p{L}\p{N}]+", r"[^\p{L}\p{N}\n]+"


def _form(text: Column, between: str) -> Column:
    """Words in lower case and one spelling, two blanks around each; ``between`` is what
    stands between words."""
    form = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, " ")
    form = F.regexp_replace(F.lower(form), between, " ")
    # Two blanks, so that a word and its neighbour have one each.
    form = F.replace(F.replace(form, F.lit("\n"), F.lit(" \n ")), F.lit(" "), F.lit("  "))
    form = F.concat(F.lit("  "), form, F.lit("  "))
    for old, new in SPELLINGS:
        form = F.replace(form, F.lit(f" {old.replace(' ', '  ')} "),
                         F.lit(f" {new.replace(' ', '  ')} "))
    return form


def _single(form: Column) -> Column:
    return F.trim(F.regexp_replace(form, " +", " "))


def canonical(text: Column) -> Column:
    """Canonical form of a text; null reads as empty."""
    return _single(_form(text, WHOLE))


def canonical_lines(text: Column) -> Column:
    """Canonical forms of a text's lines, each as if it stood alone."""
    return F.transform(F.split(_form(text, LINES), "\n"), _single)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_texts() -> list[tuple[str, str]]:
    """The built-in list: short texts under their titles, notices, and the system's licences."""
    return [*titled(TEXTS), *NOTICES, *system_texts()]


def known_digests(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest, license, size`` of known texts: (name, text) pairs, by default the built-in list.

    ``size`` is the canonical form's length.  Texts with one canonical form share a digest;
    the first name in order stands for it."""
    rows = spark.createDataFrame(known_texts() if texts is None else texts,
                                 "license string, body string")
    form = rows.select(canonical(F.col("body")).alias("form"), "license")
    return form.groupBy(F.sha2("form", 256).alias("digest")).agg(
        F.min("license").alias("license"), F.max(F.length("form")).alias("size"))


def scan(docs: DataFrame, known: DataFrame, notices: DataFrame | None = None,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digest, license, line_licenses``, a row per row of ``docs``.

    ``license`` names the known licence that the whole document is (else null);
    ``line_licenses`` lists, sorted and comma-joined, the licences whose entire notice
    is one of its lines (empty if none).  Null and empty texts have the digest of
    the empty text and no licence.  Repeated rows and ids each keep their row.  Texts and
    lines of any length are read whole.  Empty tables give no rows; other columns are
    ignored.

    ``known`` and ``notices`` (by default the built-in ones; ``known_digests``) are joined,
    however many.  A line is digested once, and only if some notice's canonical form
    has its length, which no other line can equal.
    """
    spark = docs.sparkSession
    notices = known_digests(spark, NOTICES) if notices is None else notices
    sizes = [r["size"] for r in notices.select("size").distinct().collect()]   # lengths, not texts
    body = docs[text].cast("string")
    lines = F.filter(canonical_lines(body), lambda x: F.length(x).isin(sizes)) if sizes else F.array()
    base = written(docs.select(
        F.monotonically_increasing_id().alias("row"), docs[doc_id].cast("long").alias("doc_id"),
        digest(body).alias("digest"), F.transform(F.array_distinct(lines.cast("array<string>")),
                                                  lambda x: F.sha2(x, 256)).alias("lines")), "digests")
    hits = base.select("row", F.explode("lines").alias("digest")).join(
        notices.select("digest", "license"), "digest").groupBy("row").agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("line_licenses"))
    return base.join(known.select("digest", "license"), "digest", "left").join(
        hits, "row", "left").select(
        "doc_id", "digest", "license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"))
