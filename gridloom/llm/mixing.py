"""Mixing sources to target weights by hash thresholds, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a document's hash that one histogram divides.
LEVEL_BITS = 10
LEVELS = 2
HASH_BITS = 60


def doc_hash(key: str) -> Column:
    """60 bits of the key's MD5, so that other engines can find the same value."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from a source's size, one row per source.

    Weights are 1, 2, 3, repeating, by code point order of the source, null last. Targets share out share x all sizes by
    weight. A target above cap x its source's size stops there and the excess goes to the others by weight: sources
    stop in order of size per weight, so running sums in that order find the level at which no more stop.
    """
    sizes = sizes.withColumn("w", ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1).cast("double"))
    up = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    x = sizes.withColumn("most", cap * F.col("source_size").cast("double")).withColumn("budget", share * F.sum("source_size").over(Window.partitionBy()))
    x = x.withColumn("full", F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).withColumn("left", F.sum("w").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    x = x.withColumn("level", (F.col("budget") - F.col("full")) / F.col("left")).withColumn("stops", F.col("level") * F.col("w") >= F.col("most"))
    # the level of the first source that doesn't stop holds for all after it
    x = x.withColumn("place", F.row_number().over(up))
    x = x.withColumn("final", F.min(F.when(~F.col("stops"), F.struct("place", "level"))).over(Window.partitionBy())["level"])
    return x.select("source", "source_size", F.when(F.col("stops"), F.col("most")).otherwise(F.least("most", F.col("final") * F.col("w"))).alias("target"))


def mix(docs: DataFrame, share: float = 1.0, cap: float = 3.0, rounds: int = 3, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, size, source_size, target, taken) for every row.

    Size: words in the text (null: 0). Every document of a source is taken as many whole times as its target holds the
    source; the rest of the target goes to documents whose hash lies under a threshold. Histograms of words by source
    and hash bucket find the bucket where the sums reach the rest, only that bucket is divided further, and the last one
    is cut; further rounds fill what is missing then from documents no larger than it. Equal keys have equal hashes, and are taken together. A null source is one of its
    own, last in order. Sources without words have target 0 and nothing taken. Empty table: no rows.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    sized = staged(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"), doc_hash(key).alias("h")), "sized")
    goal = staged(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, cap).select(
        "*", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"),
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "goal")

    # Rounds fill the rest with ever smaller documents: of those not taken yet that are no larger than what is left, the
    # hashes under a threshold are taken, the last time to the nearest word count. steps: (largest size, threshold).
    state = goal.select("source", "rest", F.array().cast("array<struct<most: long, under: long>>").alias("steps"))
    for k in range(rounds):
        state = staged(_threshold(sized, state, nearest=k == rounds - 1), "steps")
    plan = goal.join(state.select(F.col("source").alias("s"), "steps"), goal["source"].eqNullSafe(F.col("s"))).select(goal["source"].alias("s"), "source_size", "target", "whole", "steps")
    out = sized.join(plan, F.col("source").eqNullSafe(F.col("s")))
    times = F.col("whole") + _taken().cast("long")
    return out.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def _taken() -> Column:
    return F.exists("steps", lambda x: (F.col("size") <= x["most"]) & (F.col("h") < x["under"]))


def _threshold(sized: DataFrame, state: DataFrame, nearest: bool) -> DataFrame:
    """state with one more step for each source, and the words still missing after it."""
    most = F.when(F.size("steps") == 0, F.lit(1 << 62)).otherwise(F.floor("rest"))
    ask = state.select(F.col("source").alias("s"), "rest", "steps", most.alias("most"))
    x = sized.join(ask, F.col("source").eqNullSafe(F.col("s"))).where((F.col("size") > 0) & (F.col("size") <= F.col("most")) & ~_taken()).select("source", "h", "size")
    edge = state.select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("got"))
    shift = HASH_BITS
    for _ in range(LEVELS):
        shift -= LEVEL_BITS
        near = edge.select(F.col("source").alias("s"), "prefix")
        inside = x.join(near, F.col("source").eqNullSafe(F.col("s")) & (F.shiftrightunsigned("h", shift + LEVEL_BITS) == F.col("prefix")))
        edge = staged(_boundary(inside.groupBy("source", F.shiftrightunsigned("h", shift).alias("bucket")).agg(F.sum("size").alias("n")), edge), "edge")  # one row a source
    last = x.join(edge.select(F.col("source").alias("s"), "prefix"), F.col("source").eqNullSafe(F.col("s")) & (F.shiftrightunsigned("h", shift) == F.col("prefix")))
    cut = _cut(last.groupBy("source", F.col("h").alias("bucket")).agg(F.sum("size").alias("n")), edge, shift, nearest)
    return ask.join(cut, ask["s"].eqNullSafe(cut["source"]), "left").select(
        ask["s"].alias("source"), (ask["rest"] - F.coalesce("upto", F.lit(0))).alias("rest"),
        F.concat("steps", F.array(F.struct("most", F.coalesce("under", F.lit(0)).cast("long").alias("under")))).alias("steps"),
    )


def _boundary(buckets: DataFrame, edge: DataFrame) -> DataFrame:
    """Of each source, the first bucket where the sum reaches the rest, or the last one."""
    x = buckets.join(edge.select(F.col("source").alias("s"), "rest", "got"), F.col("source").eqNullSafe(F.col("s")))
    x = x.withColumn("upto", F.col("got") + F.sum("n").over(Window.partitionBy("source").orderBy("bucket")))
    at = F.min_by(F.struct("bucket", "n", "upto"), F.when(F.col("upto") >= F.col("rest"), F.col("bucket")))
    x = x.groupBy("source").agg(F.coalesce(at, F.max_by(F.struct("bucket", "n", "upto"), "bucket")).alias("at"), F.first("rest").alias("rest"))
    return x.select("source", "rest", F.col("at.bucket").alias("prefix"), (F.col("at.upto") - F.col("at.n")).alias("got"))


def _cut(hashes: DataFrame, edge: DataFrame, shift: int, nearest: bool) -> DataFrame:
    """Of each source, the threshold under which the words come nearest to the rest, or stay within it; ties take fewer."""
    x = hashes.join(edge.select(F.col("source").alias("s"), "rest", "got"), F.col("source").eqNullSafe(F.col("s")))
    upto = F.col("got") + F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
    ends = x.select("source", "rest", upto.alias("upto"), (F.col("bucket") + 1).alias("under"))
    starts = edge.select("source", "rest", F.col("got").alias("upto"), F.shiftleft("prefix", shift).alias("under"))
    both = ends.unionByName(starts)
    if not nearest:
        both = both.where("upto <= rest")
    best = F.min_by(F.struct("upto", "under"), F.struct(F.abs(F.col("upto") - F.col("rest")), F.col("under")))
    return both.groupBy("source").agg(best.alias("best")).select("source", "best.upto", "best.under")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), share=1.0, cap=3.0).drop("source")


QUERIES = {"op10_mixing": op10_mixing}
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents
),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w, 3.0::DOUBLE * source_size AS most, (sum(source_size) OVER ())::DOUBLE AS budget FROM s0),
s2 AS (SELECT *, coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS f,
  sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS l FROM s1),
s3 AS (SELECT *, (budget - f) / l AS level, (budget - f) / l * w >= most AS stops, row_number() OVER (ORDER BY most / w, source NULLS LAST) AS place FROM s2),
s4 AS (SELECT *, (arg_min(level, place) FILTER (WHERE NOT stops) OVER ()) AS final FROM s3),
goal AS (SELECT source, source_size, CASE WHEN stops THEN most ELSE least(most, final * w) END AS target FROM s4),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM goal),
g1 AS (SELECT *, target - whole * source_size AS rest FROM g),
r1 AS (SELECT d.doc_id, d.source, d.size, d.h, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) <= g1.rest AS t FROM d JOIN g1 ON d.source IS NOT DISTINCT FROM g1.source WHERE d.size > 0),
g2 AS (SELECT g1.source, g1.rest - coalesce((SELECT sum(size) FROM r1 WHERE t AND r1.source IS NOT DISTINCT FROM g1.source), 0) AS rest FROM g1),
r2 AS (SELECT r1.*, sum(r1.size) OVER (PARTITION BY r1.source ORDER BY r1.h) <= g2.rest AS t2 FROM r1 JOIN g2 ON r1.source IS NOT DISTINCT FROM g2.source WHERE NOT t AND r1.size <= floor(g2.rest)),
g3 AS (SELECT g2.source, g2.rest - coalesce((SELECT sum(size) FROM r2 WHERE t2 AND r2.source IS NOT DISTINCT FROM g2.source), 0) AS rest FROM g2),
open3 AS (SELECT r1.doc_id, r1.source, r1.size, r1.h FROM r1 WHERE NOT t AND doc_id NOT IN (SELECT doc_id FROM r2 WHERE t2)),
c3 AS (SELECT o.*, g3.rest, sum(o.size) OVER (PARTITION BY o.source ORDER BY o.h) AS upto FROM open3 o JOIN g3 ON o.source IS NOT DISTINCT FROM g3.source WHERE o.size <= floor(g3.rest)),
n3 AS (SELECT source, min(abs(upto - rest)) AS near, min(rest) AS rest FROM c3 GROUP BY source),
b3 AS (SELECT c3.source, min(upto) AS upto FROM c3 JOIN n3 ON c3.source IS NOT DISTINCT FROM n3.source AND abs(c3.upto - c3.rest) = n3.near WHERE n3.near < n3.rest GROUP BY c3.source),
t3 AS (SELECT c3.doc_id FROM c3 JOIN b3 ON c3.source IS NOT DISTINCT FROM b3.source WHERE c3.upto <= b3.upto)
SELECT d.doc_id, d.size, g1.source_size, g1.target,
  d.size * (g1.whole + CASE WHEN d.doc_id IN (SELECT doc_id FROM r1 WHERE t UNION ALL SELECT doc_id FROM r2 WHERE t2 UNION ALL SELECT doc_id FROM t3) THEN 1 ELSE 0 END) AS taken
FROM d JOIN g1 ON d.source IS NOT DISTINCT FROM g1.source
"""

ORACLES = {"op10_mixing": SQL}
