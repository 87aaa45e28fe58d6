"""Weather-shaped views of the given tables, in DataFrames and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stats import long

START, END = "2024-01-01 00:00:00", "2024-01-30 23:00:00"
CELLS = 24


def register(queries: dict, oracles: dict) -> Callable:
    """A decorator: @query(name, sql) enters a function under its name."""

    def query(name: str, sql: str | None = None) -> Callable:
        def enter(f: Callable) -> Callable:
            queries[name] = f
            if sql:
                oracles[name] = sql
            return f

        return enter

    return query


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A given table; times without zone are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return df.select(*(F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes))


def at(c: str = "time") -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def r6(c: str | Column, name: str | None = None, digits: int = 6) -> Column:
    return F.round(c, digits).alias(name or c)


def obs_wide(spark: SparkSession, d: str) -> DataFrame:
    """(time, cell_id, u10, v10, tp) from events."""
    e = table(spark, d, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("double")
    raw = e.select(
        F.date_trunc("hour", "ts").alias("time"), (F.col("user_id") % CELLS).alias("cell_id"),
        F.when(F.col("event_type") != "error", F.col("value") - 20).alias("u10"),
        F.when(F.col("event_type") != "signup", k - 50).alias("v10"),
        F.when(F.col("event_type") == "purchase", F.col("value") / 1000).alias("tp"),
    )
    return raw.groupBy("time", "cell_id").agg(F.avg("u10").alias("u10"), F.avg("v10").alias("v10"), F.sum("tp").alias("tp"))


def obs(spark: SparkSession, d: str) -> DataFrame:
    """(time, cell_id, var, value)."""
    return long(obs_wide(spark, d), ["u10", "v10", "tp"])


def frames(spark: SparkSession, d: str) -> DataFrame:
    """(ts, cell_id, value) with sentinels, at irregular times."""
    value = F.when(F.col("event_type") == "error", -999.0).when(F.col("event_type") == "signup", -99.0).otherwise(F.col("value"))
    return table(spark, d, "events").select("ts", (F.col("user_id") % CELLS).alias("cell_id"), value.alias("value"))


def cycles(spark: SparkSession, d: str) -> DataFrame:
    """(init_time, lead_hour, cell_id, value) from orders."""
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_orderdate").alias("init_time"), (F.col("o_orderkey") % 3 + 1).alias("lead_hour"), (F.col("o_custkey") % 50).alias("cell_id")).agg(F.avg("o_totalprice").alias("value"))


def levels(spark: SparkSession, d: str) -> DataFrame:
    """(time, cell_id, var, level, value) from lineitem."""
    x = table(spark, d, "lineitem")
    var = F.when(F.col("l_returnflag") == "A", "u").when(F.col("l_returnflag") == "N", "v").otherwise("t")
    level = F.element_at(F.array(*map(F.lit, (500, 700, 850, 925, 1000))), (F.col("l_linenumber") % 5 + 1).cast("int"))
    return x.groupBy(F.col("l_shipdate").alias("time"), (F.col("l_suppkey") % 10).alias("cell_id"), var.alias("var"), level.alias("level")).agg(F.avg("l_extendedprice").alias("value"))


def lat_step(spark: SparkSession, d: str) -> float:
    """Degrees between rows of the grid: all of its rows, however many, lie in 11 degrees."""
    return 11.0 / ((table(spark, d, "customer").agg(F.max(F.expr("c_custkey div 40"))).first()[0] or 0) + 1)


def grid(spark: SparkSession, d: str) -> DataFrame:
    """(cell_id, y, x, latitude, longitude, field) from customer: a slightly skewed grid of 40 columns."""
    c, dy = table(spark, d, "customer"), lat_step(spark, d)
    g = c.select(F.col("c_custkey").alias("cell_id"), F.expr("cast(c_custkey div 40 as int)").alias("y"), (F.col("c_custkey") % 40).cast("int").alias("x"), F.col("c_acctbal").alias("field"))
    return g.select("cell_id", "y", "x", (F.lit(39.0) + F.lit(dy) * F.col("y") + F.lit(0.01) * F.col("x")).alias("latitude"), (F.lit(276.0) + F.lit(0.45) * F.col("x")).alias("longitude"), "field")


def regular_grid(spark: SparkSession, d: str) -> DataFrame:
    return grid(spark, d).withColumn("latitude", F.lit(39.0) + F.lit(lat_step(spark, d)) * F.col("y"))


def registry(spark: SparkSession, d: str) -> DataFrame:
    """(target_var, family, level, run_type, source_var, long_name, price) from part; keys repeat."""
    mode = F.when(F.col("p_size") % 3 == 0, "both").when(F.col("p_size") % 3 == 1, "anl").otherwise("fcst")
    p = table(spark, d, "part")
    return p.select("p_partkey", F.col("p_name").alias("target_var"), F.col("p_type").alias("family"), F.col("p_brand").alias("level"), mode.alias("run_type"), F.concat(F.lit("v"), (F.col("p_partkey") % 97).cast("string")).alias("source_var"), F.concat_ws(" ", "p_type", "p_name").alias("long_name"), F.col("p_size").alias("size"))


def manifest(spark: SparkSession, d: str) -> DataFrame:
    """(path, size, date, kind, code, doc_id) from documents."""
    x = table(spark, d, "documents")
    date = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int"))
    day = F.date_format(date, "yyyyMMdd")
    path = F.concat(F.lit("RAW/"), "source", F.lit("/"), day, F.lit("/"), "lang", F.lit("_"), day, F.lit("-"), F.lpad((F.col("doc_id") % 24).cast("string"), 2, "0"), F.lit("0000.grib2.gz"))
    return x.select(path.alias("path"), (F.col("n_chars") * 1024).alias("size"), date.alias("date"), F.col("source").alias("kind"), F.col("lang").alias("code"), "doc_id")


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """A simulation catalogue from supplier: one row a supplier."""
    s = table(spark, d, "supplier")
    first = (F.lit(1990) + F.col("s_nationkey")).cast("int")
    return s.select(
        F.col("s_suppkey").cast("int").alias("index"), F.concat(F.lit("M"), F.col("s_nationkey").cast("string")).alias("source_id"),
        F.when(F.col("s_suppkey") % 2 == 0, "historical").otherwise("evaluation").alias("experiment_id"), F.lit("r1i1p1").alias("variant"), F.lit("v1-r1").alias("realization"),
        F.concat(first.cast("string"), F.lit("01010000-"), (first + 2).cast("string"), F.lit("12312300")).alias("ncml_timerange"),
        first.alias("sim_start_year"), (first + 2).alias("sim_end_year"), F.concat(F.lit("M"), F.col("s_nationkey").cast("string"), F.lit("/out")).alias("dest_subdir"),
    )


WIDE = r"""
raw AS (SELECT date_trunc('hour', ts) AS time, user_id % 24 AS cell_id, CASE WHEN event_type <> 'error' THEN value - 20 END AS u10,
  CASE WHEN event_type <> 'signup' THEN CAST(regexp_extract(props, '(\d+)', 1) AS DOUBLE) - 50 END AS v10,
  CASE WHEN event_type = 'purchase' THEN value / 1000 END AS tp FROM events),
wide AS (SELECT time, cell_id, avg(u10) AS u10, avg(v10) AS v10, sum(tp) AS tp FROM raw GROUP BY ALL)"""
OBS = WIDE + """,
obs AS (SELECT time, cell_id, 'u10' AS var, u10 AS value FROM wide WHERE u10 IS NOT NULL
  UNION ALL SELECT time, cell_id, 'v10', v10 FROM wide WHERE v10 IS NOT NULL UNION ALL SELECT time, cell_id, 'tp', tp FROM wide WHERE tp IS NOT NULL)"""
SPINE = """
spine AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS time)"""
FRAMES = """
frames AS (SELECT ts, user_id % 24 AS cell_id, CASE event_type WHEN 'error' THEN -999.0::DOUBLE WHEN 'signup' THEN -99.0::DOUBLE ELSE value END AS value FROM events)"""
CYCLES = """
cycles AS (SELECT o_orderdate AS init_time, o_orderkey % 3 + 1 AS lead_hour, o_custkey % 50 AS cell_id, avg(o_totalprice) AS value FROM orders GROUP BY ALL)"""
LEVELS = """
levels AS (SELECT l_shipdate AS time, l_suppkey % 10 AS cell_id, CASE l_returnflag WHEN 'A' THEN 'u' WHEN 'N' THEN 'v' ELSE 't' END AS var,
  [500, 700, 850, 925, 1000][1 + l_linenumber % 5] AS level, avg(l_extendedprice) AS value FROM lineitem GROUP BY ALL)"""
GRID = """
gy AS (SELECT 11.0::DOUBLE / (max(c_custkey // 40) + 1) AS dy FROM customer),
grid AS (SELECT c_custkey AS cell_id, CAST(c_custkey // 40 AS INTEGER) AS y, CAST(c_custkey % 40 AS INTEGER) AS x,
  39.0::DOUBLE + dy * (c_custkey // 40) + 0.01::DOUBLE * (c_custkey % 40) AS latitude, 276.0::DOUBLE + 0.45::DOUBLE * (c_custkey % 40) AS longitude,
  c_acctbal AS field FROM customer, gy)"""
REGULAR = GRID + """,
regular AS (SELECT cell_id, y, x, 39.0::DOUBLE + dy * y AS latitude, longitude, field FROM grid, gy)"""
REGISTRY = """
registry AS (SELECT p_partkey, p_name AS target_var, p_type AS family, p_brand AS level, CASE p_size % 3 WHEN 0 THEN 'both' WHEN 1 THEN 'anl' ELSE 'fcst' END AS run_type,
  'v' || (p_partkey % 97) AS source_var, p_type || ' ' || p_name AS long_name, p_size AS size FROM part)"""
MANIFEST = """
m0 AS (SELECT *, DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS date FROM documents),
manifest AS (SELECT 'RAW/' || source || '/' || strftime(date, '%Y%m%d') || '/' || lang || '_' || strftime(date, '%Y%m%d') || '-' || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || '0000.grib2.gz' AS path,
  n_chars * 1024 AS size, CAST(date AS DATE) AS date, source AS kind, lang AS code, doc_id FROM m0)"""
CATALOG = """
catalog AS (SELECT CAST(s_suppkey AS INTEGER) AS index, 'M' || s_nationkey AS source_id, CASE WHEN s_suppkey % 2 = 0 THEN 'historical' ELSE 'evaluation' END AS experiment_id,
  'r1i1p1' AS variant, 'v1-r1' AS realization, (1990 + s_nationkey) || '01010000-' || (1992 + s_nationkey) || '12312300' AS ncml_timerange,
  CAST(1990 + s_nationkey AS INTEGER) AS sim_start_year, CAST(1992 + s_nationkey AS INTEGER) AS sim_end_year, 'M' || s_nationkey || '/out' AS dest_subdir FROM supplier)"""
T = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
TIME = T.format("time")
