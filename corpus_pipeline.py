"""A corpus cleaned, mixed and packed: stages that each take the documents the one before kept.

Each stage returns the columns of documents, but for the last, whose rows are the pieces of packed windows. Columns besides
these are left out, whatever their names. An empty table gives an empty one at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import linededup, mixing, nearjoin, packing, toxicity
from gridloom.llm.staging import release, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score, learned from the labels of these documents, is under 0.5.

    Null and empty texts get the score of documents without terms. Repeated rows are scored each, and so go or stay
    together. Labels of documents that aren't there, null labels and null keys teach nothing; without labels of both
    kinds all documents have one score, the share of toxic labels (0.5 without any, and then none stays).
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out())
    docs = docs.select(*COLUMNS)
    return toxicity.score(docs, toxicity.fit(docs, labels)).where("score < 0.5").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller document has; n_chars follows the text where lines went.

    Null texts stay null, empty ones empty. Of equal lines, those of the smallest doc_id stay, all of them; rows that repeat
    a doc_id are one document and lose nothing to each other. A null doc_id is smaller than any other.
    """
    x = linededup.kept_lines(docs.select(*COLUMNS))
    return x.select("doc_id", F.when(F.col("text").isNotNull(), F.col("_kept")).alias("text"), "lang", "source", F.when(F.col("_n_dropped") > 0, F.length("_kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of similarity 0.8 join, the document of smallest doc_id.

    Null texts count as empty and are copies of empty ones. Of rows with one doc_id and one text one stays; rows with one
    doc_id and different texts are different documents, which all stay if that doc_id is its group's smallest. Rows without
    doc_id are in no group and stay.
    """
    docs = docs.select(*COLUMNS)
    keep = nearjoin.near_duplicates(docs).where("doc_id = class_id").select("doc_id").distinct()
    kept = docs.join(keep, "doc_id", "left_semi")
    whole = F.coalesce("text", F.lit(""))
    once = kept.withColumns({"_a": F.xxhash64(whole), "_b": F.xxhash64(F.lit("second"), whole)}).dropDuplicates(["doc_id", "_a", "_b"])
    return once.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them: those of no whole time go, repeated ones are rows again.

    Documents without words (null, empty or blank texts) cost nothing and stay once. Rows that repeat a doc_id in a source
    are taken together. A null source is a source of its own.
    """
    docs = docs.select(*COLUMNS)
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int"))
    taken = mixing.mix(docs).groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source")).agg(F.coalesce(F.max(times), F.lit(0)).alias("_times"))
    x = docs.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")))
    words = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)) > 0
    x = x.withColumn("_times", F.when(words, F.col("_times")).otherwise(1)).where("_times > 0")
    return x.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 4096 tokens.

    Null and empty texts are the end id alone. Repeated rows are documents of their own: each has all its pieces.
    """
    return packing.pack(docs.select(*COLUMNS), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]
#: The stages' models, MinHash and tokens can't be told in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of documents, each stage's rows written to the shared folder and its predecessor's
    deleted then; the pieces stay."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    return docs
