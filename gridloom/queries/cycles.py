"""Forecast cycles and vertical levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align, audit, select, stats
from .views import CYCLES, LEVELS, TIME, at, cycles, levels, r6, register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
V = "v AS (SELECT init_time + to_hours(lead_hour) AS time, cell_id, lead_hour, value FROM cycles)"


@query("t05_valid_time", f"WITH {CYCLES}, {V} SELECT {TIME}, cell_id, round(value, 6) AS value FROM v")
def t05(spark, d):
    return align.valid_time(cycles(spark, d)).select(at(), "cell_id", r6("value"))


@query("t06_valid_time_of_month", f"WITH {CYCLES}, {V} SELECT {TIME}, cell_id, round(value, 6) AS value FROM v WHERE strftime(time, '%Y-%m') = '1996-03'")
def t06(spark, d):
    return align.valid_time(cycles(spark, d), month="1996-03", longest=3).select(at(), "cell_id", r6("value"))


@query("t07_prefer_valid_time", f"WITH {CYCLES} SELECT strftime(CASE WHEN lead_hour > 1 THEN init_time + to_hours(lead_hour) ELSE init_time END, '%Y-%m-%d %H:%M:%S') AS time, count(*) AS n FROM cycles GROUP BY ALL")
def t07(spark, d):
    x = cycles(spark, d).withColumn("time", F.col("init_time"))
    x = x.withColumn("valid_time", F.when(F.col("lead_hour") > 1, F.timestamp_seconds(F.unix_seconds("init_time") + F.col("lead_hour") * 3600)))
    return align.prefer_valid_time(x).groupBy(at()).agg(F.count("*").alias("n"))


@query("s07_run_of_valid_time", f"WITH {CYCLES}, s AS (SELECT DISTINCT init_time + INTERVAL 1 HOUR AS time FROM cycles WHERE init_time < '1996-01-01') SELECT strftime(s.time, '%Y-%m-%d %H:%M:%S') AS time, cell_id, round(value, 6) AS value FROM s JOIN cycles c ON c.init_time = s.time - INTERVAL 1 HOUR AND c.lead_hour = 1")
def s07(spark, d):
    c = cycles(spark, d)
    spine = c.where("init_time < timestamp'1996-01-01 00:00:00'").select(F.timestamp_seconds(F.unix_seconds("init_time") + 3600).alias("time")).distinct()
    return align.run_of(spine, 1).join(c, ["init_time", "lead_hour"]).select(at(), "cell_id", r6("value"))


@query("a21_missing_frames", "WITH c AS (SELECT o_orderdate AS init_time, o_orderkey % 3 + 1 AS lead_hour, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value FROM orders) SELECT strftime(init_time, '%Y-%m-%d %H:%M:%S') AS init_time, lead_hour, count(value) < count(*) AS any_missing, count(value) = 0 AS all_missing FROM c GROUP BY ALL")
def a21(spark, d):
    from .views import table

    o = table(spark, d, "orders")
    x = o.select(F.col("o_orderdate").alias("init_time"), (F.col("o_orderkey") % 3 + 1).alias("lead_hour"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value"))
    return audit.empty_frames(x).select(at("init_time"), "lead_hour", "any_missing", "all_missing")


@query("s06_select_messages", f"WITH {LEVELS} SELECT {TIME}, cell_id, round(value, 6) AS value FROM levels WHERE var = 't' AND level = 850")
def s06(spark, d):
    return levels(spark, d).where("var = 't' and level = 850").select(at(), "cell_id", r6("value"))


@query("p14_select_levels", f"WITH {LEVELS} SELECT level, var, count(*) AS n, round(avg(value), 4) AS mean FROM levels WHERE level IN (500, 925) GROUP BY ALL")
def p14(spark, d):
    x = select.select_levels(levels(spark, d), [925.000001, 500, 500])
    return x.groupBy("level", "var").agg(F.count("*").alias("n"), r6(F.avg("value"), "mean", 4))


@query("p20_squeeze", f"WITH {LEVELS} SELECT {TIME}, cell_id, var, round(value, 6) AS value FROM levels WHERE level = 1000")
def p20(spark, d):
    return select.squeeze(levels(spark, d).where("level = 1000"), "level").select(at(), "cell_id", "var", r6("value"))


@query("a23_pivot_levels", f"WITH {LEVELS} SELECT {TIME}, cell_id, " + ", ".join(f"round(max(CASE WHEN var = '{v}' AND level = {p} THEN value END), 6) AS {v}_{p}hpa" for v in ("u", "t") for p in (500, 850)) + " FROM levels WHERE var IN ('u', 't') AND level IN (500, 850) GROUP BY ALL")
def a23(spark, d):
    x = levels(spark, d).where("var in ('u', 't') and level in (500, 850)")
    out = stats.pivot_levels(x, ["u", "t"], [500, 850])
    return out.select(at(), "cell_id", *(r6(c) for c in out.columns if c.endswith("hpa")))


@query("j03_merge_levels", f"WITH {LEVELS}, a AS (SELECT time, cell_id, avg(value) AS u FROM levels WHERE var = 'u' GROUP BY ALL), b AS (SELECT time, cell_id, value AS t2m FROM levels WHERE var = 't' AND level = 1000) SELECT strftime(coalesce(a.time, b.time), '%Y-%m-%d %H:%M:%S') AS time, coalesce(a.cell_id, b.cell_id) AS cell_id, round(u, 6) AS u, round(t2m, 6) AS t2m FROM a FULL JOIN b ON a.time = b.time AND a.cell_id = b.cell_id")
def j03(spark, d):
    x = levels(spark, d)
    ml = x.where("var = 'u'").groupBy("time", "cell_id").agg(F.avg("value").alias("u"))
    sfc = x.where("var = 't'").select("time", "cell_id", F.when(F.col("level") == 1000, "sl").otherwise("pl").alias("grp"), F.col("value").alias("t2m"))
    return align.merge_levels(ml, sfc).select(at(), "cell_id", r6("u"), r6("t2m"))


@query("w06_level_upsert", f"WITH {LEVELS}, n AS (SELECT time, cell_id, var, level, value / 2 AS value FROM levels WHERE level = 700 AND var = 'v'), o AS (SELECT time, cell_id, var, level, value FROM levels WHERE var = 'v') SELECT level, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT * FROM n UNION ALL SELECT * FROM o WHERE level <> 700) GROUP BY ALL")
def w06(spark, d):
    from ..sources.store import replaced

    x = levels(spark, d).where("var = 'v'")
    out = replaced(x, x.where("level = 700").withColumn("value", F.col("value") / 2), "time", "cell_id", "var", "level")
    return out.groupBy("level").agg(F.count("*").alias("n"), r6(F.sum("value"), "total", 4))
