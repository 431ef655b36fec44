"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A seed is a fixed mask over a span of tokens; positions the mask leaves out may
differ, and no stretch that the threshold accepts is without a seed.  Every place of
a training text and of a test item is hashed under each mask, the hashes are joined,
and around each hit the two token sequences are laid over each other on the hit's
diagonal: the best stretch of the overlap, in which a few substitutions may stand,
decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import word_terms, written

# Fixed masks: places that must agree.  A stretch's running sum (+1 a match, -2 a
# substitution) stays above 0 from its first word on, so its first five matches stand
# as 11111, 111011 or 111101: any stretch of five matches or more begins with a seed.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 2, 3, 5))
SPAN = 5
SHORT = 5                          # items of so many words count where they are the whole text
BROADCAST_BYTES = 64 << 20         # seeds and items broadcast in one pass
SEED_BYTES = 96                    # of a seed's three numbers in a hashed relation
WORD_BYTES = 16                    # of a word besides its letters


def _seed(words: Column, at: Column, mask: tuple[int, ...], length: Column) -> Column:
    """Hash of the masked words from (0-based) place ``at``; null if they leave the text."""
    return F.when(at + mask[-1] < length,
                  F.xxhash64(F.lit(str(mask)), *(F.get(words, at + o) for o in mask)))


def test_items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item_id, item``: every item's words, without rows that have no id or no word."""
    return items.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("long").alias("item_id"),
        word_terms(F.col(text).cast("string")).alias("item")).where(F.size("item") > 0).distinct()


def test_seeds(words: DataFrame) -> DataFrame:
    """``h, item_id, ipos, variant``: every seed of every item (``variant`` tells items of
    one id apart); an item of ``SHORT`` words or less has one, the hash of all its words."""
    long = F.size("item") > SHORT
    at = words.where(long).select("item_id", "variant", "item",
                                  F.posexplode("item").alias("ipos", "_w"))
    every = at.select("item_id", "variant", "ipos", F.explode(F.array(*(
        _seed(F.col("item"), F.col("ipos"), m, F.size("item")) for m in MASKS))).alias("h"))
    whole = words.where(~long).select("item_id", "variant", F.lit(0).alias("ipos"),
                                      _whole(F.col("item")).alias("h"))
    return every.where("h IS NOT NULL").unionByName(whole)


def _whole(words: Column) -> Column:
    """Hash of a short text's words."""
    return F.xxhash64(F.lit("whole"), F.array_join(words, " "))


def stretch(doc: Column, item: Column, bonus: int = 1, malus: int = 2) -> Column:
    """Matched words in the best stretch of two aligned word arrays of one length.

    A matching word adds ``bonus``, a differing one takes ``malus``; the best stretch
    has the highest sum (Kadane), and its matches are counted along."""
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("hits"), F.lit(0).alias("best"),
                    F.lit(0).alias("matched"))

    def step(acc: Column, same: Column) -> Column:
        total = F.greatest(F.lit(0), acc["sum"] + F.when(same, bonus).otherwise(-malus))
        hits = F.when(total == 0, 0).otherwise(acc["hits"] + same.cast("int"))
        return F.struct(total.alias("sum"), hits.alias("hits"),
                        F.greatest(acc["best"], total).alias("best"),
                        F.when(total > acc["best"], hits).otherwise(acc["matched"])
                        .alias("matched"))
    same = F.zip_with(doc, item, lambda a, b: F.coalesce(a == b, F.lit(False)))
    return F.aggregate(same, zero, step)["matched"]


def _matches(docs: DataFrame, key: Column, text: str, items: DataFrame, item_id: str,
             item_text: str, min_words: int, min_share: float) -> DataFrame:
    """``key, item_id, matched, item_words`` of documents (rows of one key) with a passage."""
    words = test_items(items, item_id, item_text).withColumn(
        "variant", F.xxhash64("item"))
    words = written(words, "test-items")
    seeds = written(test_seeds(words), "test-seeds")
    letters = words.agg(F.sum(F.octet_length(F.array_join("item", "")) + WORD_BYTES * F.size("item")))
    total = SEED_BYTES * seeds.count() + (letters.first()[0] or 0)
    passes = max(1, -(-total // BROADCAST_BYTES))
    own = docs.select(key.alias("key"), word_terms(F.col(text).cast("string")).alias("words"))
    # The outer forms keep Spark from inferring a filter that would split every text twice.
    places = own.select("key", "words", F.posexplode_outer("words").alias("pos", "_w"))
    size = F.size("words")
    short = F.when((size <= SHORT) & (F.col("pos") == 0), _whole(F.col("words")))
    hashed = places.select("key", "words", "pos", F.explode_outer(F.array(short, *(
        _seed(F.col("words"), F.col("pos"), m, size) for m in MASKS))).alias("h"))

    def hits(i: int) -> DataFrame:
        part = F.pmod(F.xxhash64("item_id", "variant"), F.lit(passes)) == i
        # The words of the document that lie under the item, null beyond its ends.
        start = F.col("pos") - F.col("ipos")
        under = F.transform(F.col("item"), lambda _, i: F.when(
            start + i >= 0, F.get(F.col("words"), start + i)))
        # A stretch starts at an end or behind a substitution; hits further on are left out.
        first = (F.col("pos") == 0) | (F.col("ipos") == 0) | (
            F.get("words", F.col("pos") - 1) != F.get("item", F.col("ipos") - 1))
        fits = (F.size("item") > SHORT) | (F.col("words") == F.col("item"))
        return hashed.join(F.broadcast(seeds.where(part)), "h").join(
            F.broadcast(words.where(part)), ["item_id", "variant"]).where(first & fits).select(
            "key", "item_id", F.size("item").alias("item_words"),
            stretch(under, F.col("item")).alias("matched"))

    found = reduce(DataFrame.union, map(hits, range(passes)))
    return found.groupBy("key", "item_id").agg(
        F.max("matched").alias("matched"), F.max("item_words").alias("item_words")).where(
        F.col("matched") >= F.least(F.lit(float(min_words)), F.col("item_words") * min_share))


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", min_words: int = 13,
                 min_share: float = 0.8) -> DataFrame:
    """``doc_id, item_id, matched, item_words``: each document that holds a passage of an item.

    A pair counts if the best overlap on some diagonal matches at least ``min_words``
    words, or ``min_share`` of an item that is shorter.  Every such pair holds a seed
    for thresholds no lower than the default ones.  An item of ``SHORT`` words or less is
    common speech inside a text, so it counts only where the document's words are the
    item's and no others.  Words are runs of letters and digits, so a text without blanks
    between words is matched as one word.  Null texts and rows without an id hold
    nothing.  Repeated rows, and rows that share an id, count as one document.  Texts of any
    length are read whole, a row each.  Empty tables give no rows; other columns are
    ignored.

    The test items' seeds and words are broadcast, about ``BROADCAST_BYTES`` in a pass
    (more only for one longer item); a larger benchmark takes several passes over the
    corpus, so nothing broadcast grows with either table.
    """
    known = docs.where(F.col(doc_id).isNotNull())
    return _matches(known, known[doc_id].cast("long"), text, items, item_id, item_text, min_words,
                    min_share).withColumnRenamed("key", "doc_id")


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", min_words: int = 13, min_share: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no passage of an item.

    Rows are judged by their texts, whatever their ids.  The digests (16 bytes) of the texts
    that go are written first, so that Spark broadcasts them only below its threshold."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(body, 256)), 1, 16)
    gone = written(_matches(docs, digest, text, items, item_id, item_text, min_words, min_share)
                   .select(F.col("key").alias("gone")).distinct(), "contaminated")
    return docs.join(gone, digest == gone.gone, "left_anti")
