"""File manifests: scans by name, choices, skips and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import audit
from ..plans import windows
from ..sources import listing, sinks
from .views import MANIFEST, at, manifest, register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)


@query("s03_month_files", f"WITH {MANIFEST} SELECT path, doc_id FROM manifest WHERE kind IN ('src1', 'src2') AND code IN ('en', 'fr') AND strftime(date, '%Y-%m') = '2024-02'")
def s03(spark, d):
    return windows.month_files(manifest(spark, d), ["src1", "src2"], ["en", "fr"], "2024-02").select("path", "doc_id")


@query("s04_day_files", f"WITH {MANIFEST} SELECT path, doc_id FROM manifest WHERE date = DATE '2024-01-13'")
def s04(spark, d):
    return windows.day_files(manifest(spark, d), "2024-01-13").select("path", "doc_id")


@query("s03_listed_files", f"WITH {MANIFEST} SELECT strftime(date, '%Y-%m-%d') AS day, 1 AS n_files, true AS filled FROM manifest WHERE date BETWEEN DATE '2024-02-01' AND DATE '2024-02-29' GROUP BY date")
def s03_listed(spark, d):
    """Files of a month in real folders, a day a folder: only those of the month are listed, and none is opened."""
    folder = sinks.scratch(spark, "landed")
    m = manifest(spark, d).select("path", F.date_format("date", "yyyy-MM-dd").alias("day"))
    m.repartition("day").write.partitionBy("day").text(folder)
    x = listing.listed(spark, folder, "day=2024-02-*", names="part-*").withColumn("day", F.date_format(listing.date_of_path(F.regexp_extract("path", r"/day=([^/]+)/", 1)), "yyyy-MM-dd"))
    return x.groupBy("day").agg(F.count("*").cast("int").alias("n_files"), (F.min("size") > 0).alias("filled"))


@query("t12_time_of_name", f"WITH {MANIFEST} SELECT doc_id, strftime(date, '%Y-%m-%d ') || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':00:00' AS time, 0 AS hour FROM manifest")
def t12(spark, d):
    return manifest(spark, d).select("doc_id", names.time_of_name(F.col("path")).alias("time"), names.hour_of_name(F.col("path")).alias("hour")).select("doc_id", at(), "hour")


@query("t08_analysis_time", f"WITH {MANIFEST} SELECT strftime(date, '%Y-%m-%d ') || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':00:00' AS time, count(*) AS n FROM manifest GROUP BY ALL")
def t08(spark, d):
    x = manifest(spark, d).withColumn("time", names.time_of_name(F.col("path")))
    return x.groupBy(at()).agg(F.count("*").alias("n"))


@query("s16_listing", f"WITH {MANIFEST}, l AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'a/.zarray' ELSE path || '/' END AS p FROM manifest) SELECT doc_id, split_part(rtrim(p, '/'), '/', -1) AS name FROM l WHERE doc_id % 5 <> 0")
def s16(spark, d):
    x = manifest(spark, d).select("doc_id", F.when(F.col("doc_id") % 5 == 0, "a/.zarray").otherwise(F.concat("path", F.lit("/"))).alias("path"))
    return x.where(~names.is_metadata(F.col("path"))).select("doc_id", names.base_name(F.col("path")).alias("name"))


@query("s17_template_file", f"WITH {MANIFEST} SELECT kind, min(path) AS path FROM manifest WHERE code = 'de' GROUP BY kind")
def s17(spark, d):
    return manifest(spark, d).where("code = 'de'").groupBy("kind").agg(F.min("path").alias("path"))


@query("s21_skip_existing", f"WITH {MANIFEST}, p AS (SELECT DISTINCT path FROM manifest WHERE doc_id % 2 = 0), h AS (SELECT DISTINCT path FROM manifest WHERE doc_id % 3 = 0) SELECT path FROM p WHERE path NOT IN (SELECT path FROM h)")
def s21(spark, d):
    m = manifest(spark, d)
    return windows.not_there(m.where("doc_id % 2 = 0").select("path").distinct(), m.where("doc_id % 3 = 0"))


@query("s22_size_verified", f"WITH {MANIFEST}, p AS (SELECT path, max(size) AS remote_size FROM manifest GROUP BY path), h AS (SELECT path, max(CASE WHEN doc_id % 4 = 0 THEN size + 1 ELSE size END) AS local_size FROM manifest WHERE doc_id % 3 > 0 GROUP BY path) SELECT p.path, p.remote_size, h.local_size FROM p LEFT JOIN h ON p.path = h.path WHERE h.local_size IS NULL OR h.local_size IS DISTINCT FROM p.remote_size")
def s22(spark, d):
    m = manifest(spark, d)
    plan = m.groupBy("path").agg(F.max("size").alias("remote_size"))
    have = m.where("doc_id % 3 > 0").withColumn("size", F.when(F.col("doc_id") % 4 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return windows.not_verified(plan, have)


@query("s24_first_file", f"WITH {MANIFEST} SELECT kind, code, min(path) AS path FROM manifest GROUP BY ALL")
def s24(spark, d):
    return windows.first_file(manifest(spark, d).select("kind", "code", "path"), "kind", "code").select("kind", "code", "path")


@query("s26_chosen_files", f"WITH {MANIFEST} SELECT doc_id, path FROM manifest WHERE path LIKE '%/en\\_%' ESCAPE '\\' AND path NOT LIKE '%-23%' OR path LIKE '%src7/%'")
def s26(spark, d):
    return windows.chosen_files(manifest(spark, d), [("exclude", ".*"), ("include", "/en_"), ("exclude", "-23"), ("include", "src7/")]).select("doc_id", "path")


@query("a15_files_per_day", f"WITH {MANIFEST}, d AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-05', INTERVAL 1 DAY)) AS DATE) AS day), k AS (SELECT date, count(*) AS n FROM manifest GROUP BY date) SELECT strftime(day, '%Y-%m-%d') AS day, coalesce(n, 0) AS n_files, coalesce(n, 0) >= 17 AS complete FROM d LEFT JOIN k ON d.day = k.date")
def a15(spark, d):
    days = spark.range(1).select(F.explode(F.expr("sequence(date'2024-01-01', date'2024-03-05', interval 1 day)")).alias("day"))
    return audit.files_per_day(manifest(spark, d), days, 17).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n_files", "complete")


@query("a16_small_files", f"WITH {MANIFEST} SELECT DISTINCT strftime(date, '%Y%m%d') AS date FROM manifest WHERE size < 512000")
def a16(spark, d):
    return audit.small_file_dates(manifest(spark, d), 512_000)


@query("o06_differences", f"WITH {MANIFEST} SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date FROM manifest WHERE kind = 'src3' EXCEPT SELECT strftime(date, '%Y-%m-%d') FROM manifest WHERE kind = 'src4'")
def o06(spark, d):
    m = manifest(spark, d)
    of = lambda k: m.where(F.col("kind") == k).select(F.date_format("date", "yyyy-MM-dd").alias("date")).distinct()
    return of("src3").exceptAll(of("src4"))
