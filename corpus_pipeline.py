"""Training-corpus pipeline: documents in, packed token sequences out.

``STAGES`` are applied in order; each stage's result is written as Parquet to the
shared folder and read again as the next one's documents, so a lost executor
never costs more than its stage.  All stages but the last return the columns
of ``documents``.  Nulls, empty and repeated rows: see each operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.llm import decontam, langid, packing, pii, simhash
from ingot.llm.common import ship, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; null texts, texts without letters and unclear ones go.  Ids
    play no part.  Documents of which none has a ``lang`` are an error."""
    ship(spark)
    return langid.accept(docs, langid.train_profiles(docs, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id, or, where none has an
    id, one of them.  Repeated rows are copies; unrelated texts under one id both stay."""
    ship(spark)
    return simhash.keep_representatives(docs, shingle=3, tau=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; null and empty texts hold none, and rows are
    judged one by one, whatever their ids."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text.  Null
    texts stay null with ``n_chars`` 0; repeated rows and ids all stay."""
    ship(spark)
    return pii.redact(docs, pii.fit(docs)).withColumn(
        "n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 ids.  Null and empty texts are
    documents of one id; repeated and null ids are documents of their own."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"),
                                  max_pieces=REMEMBERED).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


# Pieces that a worker remembers while packing: few, since it keeps them through the stages
# of further runs, beside what those need.
REMEMBERED = 60_000
STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data),
          ("packing", packed)]

# Tokenisation, n-gram profiles and connected components are not SQL; tests compare
# the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
