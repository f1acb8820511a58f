"""The corpus pipeline: five corpus operators applied one after the other to all documents.

Every stage works on what the one before kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowprism.llm import decontam, linededup, packing, quality, simhash
from flowprism.llm.common import drop_folder, shared_folder, table
from flowprism.llm.queries import findable


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents whose posterior quality is below one half go."""
    findable(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter("quality >= 0.5").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: lines that a smaller document holds go; n_chars follows the text."""
    findable(spark)
    return linededup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group only the document of least id stays, once; documents without an id cannot be named and stay.

    Rows are told apart by id and text, so rows that share an id but hold unlike texts each answer for their own group.
    """
    findable(spark)
    row = F.struct(F.col("doc_id").alias("i"), F.xxhash64("text").alias("h"))
    named = docs.select(F.when(F.col("doc_id").isNotNull(), row).alias("row"), "text")
    groups = simhash.near_dedup(named, "row", shingle=4, max_bits=4)
    firsts = groups.filter("id = component").select("id.i", "id.h").distinct()
    # the documents' own columns stand in a struct, so that none can clash with the ones used here
    whole = docs.select(F.struct("*").alias("d"), F.col("doc_id").alias("i"), F.xxhash64("text").alias("h"), F.xxhash64(*docs.columns).alias("of"))
    once = Window.partitionBy("i", "h").orderBy("of")
    kept = whole.join(firsts, ["i", "h"], "left_semi").withColumn("n", F.row_number().over(once)).filter("n = 1")
    return kept.select("d.*").union(docs.filter("doc_id is null").select(docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark item go."""
    findable(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the documents left, as pieces of sequences of at most 4,096 tokens."""
    import public_tokenizers

    findable(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [("quality", keep_good), ("line_dedup", drop_repeated_lines), ("simhash_dedup", drop_near_copies),
          ("decontamination", drop_leaks), ("packing", pack)]

#: SQL cannot express the classifier and the packing; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet to the shared folder and read again.

    The folder is this run's own; a stage's rows go once the next stage's are written, the last ones stay.
    """
    docs, folder, before = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            drop_folder(spark, before)
        before = f"{folder}/{name}"
    return docs
