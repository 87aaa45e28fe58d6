"""Observations and frames: scans, axes, audits, statistics, winds, units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import units, weather
from ..operators import align, audit, select, stats
from ..sources import sinks, store
from .views import CELLS, END, FRAMES, GRID, OBS, SPINE, START, TIME, WIDE, at, frames, grid, obs, obs_wide, r6, register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
VARS = ["u10", "v10", "tp"]
LIST = "(SELECT unnest(['u10', 'v10', 'tp']) AS var)"


def spine(spark) -> DataFrame:
    return align.axis(spark, START, END)


def stored(spark, d, x: DataFrame) -> store.Store:
    """A new store of observations."""
    kept = store.Store(spark, f"{sinks.scratch(spark, 'stations')}/store", store.Axis(START, END))
    kept.upsert(x.withColumn("product", F.lit("station")))
    return kept


@query("s01_scan_store", f"WITH {OBS} SELECT var, {TIME}, cell_id, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 3) AS value FROM obs WHERE var IN ('u10', 'v10') AND time >= '2024-01-05' AND time < '2024-01-21'")
def s01(spark, d):
    x = stored(spark, d, obs(spark, d)).open("station", ["u10", "v10"])
    return select.time_range(x, "2024-01-05", "2024-01-20").select("var", at(), "cell_id", r6(F.col("value").cast("double"), "value", 3))


@query("s05_concat_preprocess", f"WITH {OBS} SELECT var, cell_id, count(*) AS n, round(sum(value), 6) AS total FROM obs WHERE cell_id < 12 GROUP BY ALL")
def s05(spark, d):
    x = obs(spark, d)
    parts = [x.where(F.col("var") == v) for v in VARS]
    return select.preprocess_each(parts, lambda p: p.where("cell_id < 12")).groupBy("var", "cell_id").agg(F.count("*").alias("n"), r6(F.sum("value"), "total"))


@query("s08_missing_frames", f"WITH {OBS}, {SPINE} SELECT v.var, c.cell_id, strftime(s.time, '%Y-%m-%d %H:%M:%S') AS time, round(o.value, 6) AS value FROM spine s CROSS JOIN (SELECT DISTINCT var, cell_id FROM obs) c JOIN (SELECT DISTINCT var FROM obs) v ON v.var = c.var LEFT JOIN obs o ON s.time = o.time AND o.var = c.var AND o.cell_id = c.cell_id")
def s08(spark, d):
    return align.reindex(obs(spark, d), spine(spark), "var", "cell_id").select("var", "cell_id", at(), r6("value"))


@query("s19_first_step_with_data", f"WITH {OBS} SELECT var, strftime(min(time), '%Y-%m-%d %H:%M:%S') AS first_time FROM obs WHERE value IS NOT NULL GROUP BY var")
def s19(spark, d):
    return obs(spark, d).where("value is not null").groupBy("var").agg(F.date_format(F.min("time"), "yyyy-MM-dd HH:mm:ss").alias("first_time"))


@query("w01_skeleton", f"WITH {OBS} SELECT var, 720 * 24 AS n_slots, count(value) AS n_values FROM obs GROUP BY var")
def w01(spark, d):
    dense = obs(spark, d).groupBy("var").agg(F.count("value").alias("n_values"))
    return dense.crossJoin(F.broadcast(spine(spark).agg((F.count("*") * CELLS).cast("int").alias("n_slots")))).select("var", "n_slots", "n_values")


@query("w03_axis_differences", f"WITH {OBS}, {SPINE}, a AS (SELECT DISTINCT time FROM obs WHERE var = 'tp') SELECT {TIME}, 'right' AS side FROM spine WHERE time NOT IN (SELECT time FROM a)")
def w03(spark, d):
    return audit.axis_differences(obs(spark, d).where("var = 'tp'"), spine(spark)).select(at(), "side")


@query(
    "w05_keyed_upsert",
    f"""WITH {OBS}, n AS (SELECT var, time, cell_id, value + 1 AS value FROM obs WHERE time >= '2024-01-15' AND var = 'u10'), o AS (SELECT var, time, cell_id, value FROM obs WHERE time < '2024-01-17')
SELECT var, {TIME}, cell_id, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 3) AS value FROM (SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.var = o.var AND n.time = o.time AND n.cell_id = o.cell_id))""",
)
def w05(spark, d):
    x = obs(spark, d)
    new = x.where("var = 'u10' and time >= timestamp'2024-01-15 00:00:00'").withColumn("value", F.col("value") + 1)
    kept = stored(spark, d, x.where("time < timestamp'2024-01-17 00:00:00'"))
    kept.upsert(new.withColumn("product", F.lit("station")))
    return kept.open("station").select("var", at(), "cell_id", r6(F.col("value").cast("double"), "value", 3))


@query("w02_ensure_store", f"WITH {OBS}, {GRID} SELECT var, '{START}' AS start, '{END}' AS end, (SELECT count(*) FROM grid) AS n_cells, 720 AS n_times FROM obs GROUP BY var")
def w02(spark, d):
    """Stores are ensured for each variable, the first of which creates it, all twice."""
    kept = store.Store(spark, f"{sinks.scratch(spark, 'ensured')}/store", store.Axis(START, END))
    for _ in range(2):
        for r in obs(spark, d).select("var").distinct().orderBy("var").collect():  # variables are few
            kept.ensure("station", r["var"], lambda: grid(spark, d))
    sizes = kept.grid().agg(F.count("*").alias("n_cells")).join(spine(spark).agg(F.count("*").cast("int").alias("n_times")))
    return kept.described().join(F.broadcast(sizes)).select("var", "start", "end", "n_cells", "n_times")


@query("w12_rechunk", f"WITH {OBS} SELECT var, count(*) AS n, round(sum(value), 4) AS total, 4 AS n_files FROM obs GROUP BY var")
def w12(spark, d):
    path = sinks.scratch(spark, "chunks")
    store.rechunk(obs(spark, d), 4, "time").write.parquet(path)
    x = spark.read.parquet(path).select("var", "value", F.col("_metadata.file_path").alias("file"))
    return x.groupBy("var").agg(F.count("*").alias("n"), r6(F.sum("value"), "total", 4), F.count_distinct("file").cast("int").alias("n_files"))


@query("w08_off_axis_times", f"WITH {FRAMES} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, count(*) AS n FROM (SELECT DISTINCT ts FROM frames WHERE ts <> date_trunc('hour', ts)) GROUP BY ALL")
def w08(spark, d):
    return audit.off_axis(frames(spark, d).withColumnRenamed("ts", "time"), spine(spark)).groupBy(at()).agg(F.count("*").alias("n"))


@query("w09_extend_axis", f"WITH {OBS} SELECT strftime(unnest(generate_series(date_trunc('day', max(time)) + INTERVAL 24 HOUR, TIMESTAMP '2024-02-03 23:00:00', INTERVAL 1 HOUR)), '%Y-%m-%d %H:%M:%S') AS time FROM obs")
def w09(spark, d):
    last = obs(spark, d).agg(F.date_format(F.max("time"), "yyyy-MM-dd")).first()[0]
    return store.Axis(START, f"{last} 23:00:00").added(spark, "2024-02-03 23:00:00").select(at())


@query("w10_merge_parts", f"WITH {OBS} SELECT var, CAST(day(time) // 11 AS INTEGER) AS part, count(*) AS n FROM obs GROUP BY ALL")
def w10(spark, d):
    x = obs(spark, d).withColumn("part", F.expr("cast(day(time) div 11 as int)"))
    return store.merged([x.where(F.col("part") == k) for k in range(3)]).groupBy("var", "part").agg(F.count("*").alias("n"))


@query("w11_copy_range", f"WITH {OBS} SELECT {TIME}, cell_id, var, round(value, 6) AS value FROM obs WHERE var IN ('u10', 'tp') AND time BETWEEN '2024-01-03 06:00:00' AND '2024-01-04 18:00:00'")
def w11(spark, d):
    return select.time_range(obs(spark, d).where(F.col("var").isin("u10", "tp")), "2024-01-03 06:00:00", "2024-01-04 18:00:00").select(at(), "cell_id", "var", r6("value"))


@query("p01_rename_project", f"WITH {WIDE} SELECT {TIME}, cell_id, round(CAST(u10 AS FLOAT), 3)::DOUBLE AS eastward, round(CAST(v10 AS FLOAT), 3)::DOUBLE AS northward FROM wide")
def p01(spark, d):
    x = select.as_float(select.rename(obs_wide(spark, d).drop("tp", "absent"), {"u10": "eastward", "v10": "northward", "nothing": "n"}), "eastward", "northward")
    return select.only(x, "time", "cell_id", "eastward", "northward", "absent").select(at(), "cell_id", *(F.round(c, 3).cast("double").alias(c) for c in ("eastward", "northward")))


@query("p10_partial_dates", f"WITH {OBS} SELECT 'day' AS kind, count(*) AS n FROM obs WHERE time >= '2024-01-10' AND time < '2024-01-11' UNION ALL SELECT 'month', count(*) FROM obs WHERE time < '2024-02-01' AND time >= '2024-01-01' UNION ALL SELECT 'hours', count(*) FROM obs WHERE time BETWEEN '2024-01-10 05:00:00' AND '2024-01-10 07:00:00'")
def p10(spark, d):
    x = obs(spark, d)
    n = lambda kind, df: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return n("day", select.time_range(x, "2024-01-10", "2024-01-10")).union(n("month", select.month_of(x, "2024-01"))).union(n("hours", select.time_range(x, "2024-01-10 05:00:00", "2024-01-10T07:00:00")))


@query("p11_month_filter", f"WITH {OBS} SELECT var, count(*) AS n FROM obs WHERE strftime(time, '%Y-%m') = '2024-01' GROUP BY var")
def p11(spark, d):
    return select.month_of(obs(spark, d), "2024-01").groupBy("var").agg(F.count("*").alias("n"))


@query("p16_sentinels", f"WITH {FRAMES} SELECT cell_id, count(*) AS n, count(CASE WHEN NOT (value = -999 OR value = -99 OR value < -90) THEN value END) AS n_values, round(avg(CASE WHEN NOT (value = -999 OR value = -99 OR value < -90) THEN value END), 6) AS mean FROM frames GROUP BY cell_id")
def p16(spark, d):
    x = frames(spark, d).withColumn("value", weather.sentinels_to_null(F.col("value")))
    return x.groupBy("cell_id").agg(F.count("*").alias("n"), F.count("value").alias("n_values"), r6(F.avg("value"), "mean"))


@query("j01_outer_merge_first", f"WITH {OBS}, a AS (SELECT time, cell_id, value AS u10 FROM obs WHERE var = 'u10'), b AS (SELECT time, cell_id, value AS tp FROM obs WHERE var = 'tp') SELECT strftime(coalesce(a.time, b.time), '%Y-%m-%d %H:%M:%S') AS time, coalesce(a.cell_id, b.cell_id) AS cell_id, round(u10, 6) AS u10, round(tp, 6) AS tp FROM a FULL JOIN b ON a.time = b.time AND a.cell_id = b.cell_id")
def j01(spark, d):
    x = obs(spark, d)
    a = x.where("var = 'u10'").select("time", "cell_id", F.col("value").alias("u10"))
    b = x.where("var = 'tp'").select("time", "cell_id", F.col("value").alias("tp"), F.lit(0.0).alias("u10"))
    return align.merge_first(a, b, "time", "cell_id").select(at(), "cell_id", r6("u10"), r6("tp"))


@query("j02_inner_merge", f"WITH {OBS}, a AS (SELECT time, cell_id, value AS u10 FROM obs WHERE var = 'u10'), b AS (SELECT time, cell_id, value AS v10 FROM obs WHERE var = 'v10') SELECT {TIME}, cell_id, round(u10, 6) AS u10, round(v10, 6) AS v10 FROM a JOIN b USING (time, cell_id)")
def j02(spark, d):
    x = obs(spark, d)
    of = lambda v: x.where(F.col("var") == v).select("time", "cell_id", F.col("value").alias(v))
    return align.merge_common(of("u10"), of("v10"), "time", "cell_id").select(at(), "cell_id", r6("u10"), r6("v10"))


@query("j04_reindex", f"WITH {OBS}, {SPINE}, c AS (SELECT DISTINCT cell_id FROM obs WHERE var = 'v10') SELECT strftime(s.time, '%Y-%m-%d %H:%M:%S') AS time, c.cell_id, round(o.value, 6) AS value FROM spine s CROSS JOIN c LEFT JOIN obs o ON o.var = 'v10' AND o.time = s.time AND o.cell_id = c.cell_id")
def j04(spark, d):
    return align.reindex(obs(spark, d).where("var = 'v10'").select("time", "cell_id", "value"), spine(spark), "cell_id").select(at(), "cell_id", r6("value"))


SLOTTED = FRAMES + ", g AS (SELECT *, make_timestamp(CAST(floor((epoch_us(ts) + 150000000) / 300000000) AS BIGINT) * 300000000) AS slot FROM frames), s AS (SELECT *, abs(epoch_us(ts) - epoch_us(slot)) AS gap FROM g)"


@query("j05_nearest_in_time", f"WITH {SLOTTED}, h AS (SELECT *, row_number() OVER (PARTITION BY slot, cell_id ORDER BY gap, ts DESC) AS r FROM s WHERE gap <= 120000000) SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, cell_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value FROM h WHERE r = 1")
def j05(spark, d):
    slots = align.axis(spark, START, "2024-01-31 00:00:00", "5 minutes").withColumnRenamed("time", "slot")
    return align.nearest_in_time(frames(spark, d), slots, 120, 300).select(at("slot"), "cell_id", at("ts"), "value")


@query("j06_snap_to_slot", f"WITH {SLOTTED} SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, count(*) AS n FROM s WHERE gap <= 120000000 GROUP BY ALL")
def j06(spark, d):
    return frames(spark, d).select(align.snap(F.col("ts")).alias("slot")).where("slot is not null").groupBy(at("slot")).agg(F.count("*").alias("n"))


@query("n03_last_writer", f"WITH {SLOTTED}, h AS (SELECT *, row_number() OVER (PARTITION BY slot, cell_id ORDER BY gap, ts DESC) AS r FROM s WHERE gap <= 120000000) SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, cell_id, value FROM h WHERE r = 1")
def n03(spark, d):
    return align.snapped_frames(frames(spark, d)).select(at("slot"), "cell_id", "value")


@query("a01_summary", f"WITH {OBS} SELECT var, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 4) AS std FROM obs GROUP BY var")
def a01(spark, d):
    return stats.summary(obs(spark, d), ()).select("var", r6("min"), r6("max"), r6("mean"), r6("std", digits=4))


@query("a02_log_summary", f"WITH {OBS}, l AS (SELECT 'log_tp' AS var, log10(1 + value) AS value FROM obs WHERE var = 'tp') SELECT var, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 4) AS std FROM l GROUP BY var")
def a02(spark, d):
    return stats.summary(obs(spark, d)).where("var = 'log_tp'").select("var", r6("min"), r6("max"), r6("mean"), r6("std", digits=4))


@query("a03_percentiles", f"WITH {OBS}, p AS (SELECT var, cell_id, unnest(range(1, 101)) AS percentile, unnest(quantile_cont(value, [x / 100 for x in range(1, 101)])) AS value FROM obs GROUP BY var, cell_id) SELECT var, cell_id, CAST(percentile AS INTEGER) AS percentile, round(value, 9) AS value FROM p")
def a03(spark, d):
    return stats.percentiles(obs(spark, d), "var", "cell_id").select("var", "cell_id", "percentile", r6("value", digits=9))


MISSING = f"{OBS}, {SPINE}, k AS (SELECT time, var, count(value) AS n FROM obs GROUP BY ALL), m AS (SELECT v.var, s.time, coalesce(k.n, 0) AS n FROM spine s CROSS JOIN {LIST} v LEFT JOIN k ON k.time = s.time AND k.var = v.var WHERE coalesce(k.n, 0) < 24)"


@query("a04_missing_times", f"WITH {MISSING} SELECT var, {TIME}, n FROM m")
def a04(spark, d):
    return audit.missing_times(obs(spark, d), spine(spark), CELLS, VARS).select("var", at(), "n")


@query("a05_coverage_by_year", f"WITH {OBS} SELECT CAST(year(time) AS INTEGER) AS year, count(*) AS n_times FROM (SELECT DISTINCT time FROM obs) GROUP BY ALL")
def a05(spark, d):
    return audit.coverage_by_year(obs(spark, d).select("time").distinct())


@query("a06_missing_by_year", f"WITH {MISSING} SELECT var, CAST(year(time) AS INTEGER) AS year, count(*) AS n_missing FROM m GROUP BY ALL")
def a06(spark, d):
    return audit.missing_by_year(audit.missing_times(obs(spark, d), spine(spark), CELLS, VARS))


STATUS = OBS + f""", w AS (SELECT DISTINCT CAST(time AS DATE) AS win FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS time)),
k AS (SELECT var, CAST(time AS DATE) AS win, count(value) AS n FROM obs GROUP BY ALL),
st AS (SELECT v.var, strftime(w.win, '%Y-%m-%d') AS win, coalesce(k.n, 0) AS n, 24 * 24 AS expected, CASE WHEN v.var = 'sp' THEN 'missing_var' WHEN coalesce(k.n, 0) = 0 THEN 'empty' WHEN k.n < 576 THEN 'partial' ELSE 'full' END AS status
  FROM w CROSS JOIN (SELECT unnest(['u10', 'tp', 'sp']) AS var) v LEFT JOIN k ON k.var = v.var AND k.win = w.win)"""


def _status(spark, d):
    x = obs(spark, d).withColumn("window", F.to_date("time"))
    days = align.axis(spark, START, "2024-01-31 00:00:00", "1 day").select(F.to_date("time").alias("window"), F.lit(24).alias("n_times"))
    return audit.fill_status(x, days, CELLS, ["u10", "tp", "sp"])


@query("a09_fill_status", f"WITH {STATUS} SELECT * FROM st")
def a09(spark, d):
    return _status(spark, d).select("var", F.date_format("window", "yyyy-MM-dd").alias("win"), "n", "expected", "status")


@query("a07_windows_to_redo", f"WITH {STATUS} SELECT 'partial' AS policy, var, win FROM st WHERE status <> 'full' UNION ALL SELECT 'empty', var, win FROM st WHERE status IN ('missing_var', 'empty') UNION ALL SELECT 'always', var, win FROM st")
def a07(spark, d):
    st = _status(spark, d)
    of = lambda p: audit.to_redo(st, p).select(F.lit(p).alias("policy"), "var", F.date_format("window", "yyyy-MM-dd").alias("win"))
    return of("partial").union(of("empty")).union(of("always"))


@query("a08_days_with_data", f"WITH {OBS} SELECT var, strftime(CAST(time AS DATE), '%Y-%m-%d') AS win, count(value) > 0 AS present FROM obs GROUP BY ALL")
def a08(spark, d):
    return audit.window_counts(obs(spark, d), F.date_format("time", "yyyy-MM-dd"), "var").select("var", F.col("window").alias("win"), (F.col("n") > 0).alias("present"))


@query("a10_missing_days", f"WITH {FRAMES}, d AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS day) SELECT strftime(day, '%Y-%m-%d') AS day FROM d WHERE day NOT IN (SELECT CAST(ts AS DATE) FROM frames WHERE value >= -90)")
def a10(spark, d):
    x = frames(spark, d).withColumn("value", weather.sentinels_to_null(F.col("value")))
    days = align.axis(spark, START, "2024-02-05 00:00:00", "1 day").select(F.to_date("time").alias("day"))
    return audit.missing_days(x, days, "ts").select(F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("a11_missing_chunks", f"WITH {OBS}, {SPINE}, q AS (SELECT DISTINCT CAST(epoch(time - TIMESTAMP '2024-01-01') AS BIGINT) // 21600 AS chunk FROM spine), h AS (SELECT DISTINCT var, cell_id, CAST(epoch(time - TIMESTAMP '2024-01-01') AS BIGINT) // 21600 AS chunk FROM obs), k AS (SELECT DISTINCT var, cell_id FROM h) SELECT k.var, k.cell_id, q.chunk FROM k CROSS JOIN q ANTI JOIN h ON h.var = k.var AND h.cell_id = k.cell_id AND h.chunk = q.chunk")
def a11(spark, d):
    idx = align.position(F.col("time"), START, 3600)
    have = obs(spark, d).select("var", "cell_id", F.floor(idx / 6).alias("chunk"))
    return audit.missing_chunks(spine(spark).select(idx.alias("idx")), have, 6, keys=("var", "cell_id"))


@query("a12_slots_per_day", f"WITH {SLOTTED} SELECT strftime(slot, '%Y-%m-%d') AS day, count(DISTINCT slot) AS n_slots FROM s WHERE gap <= 120000000 AND value >= -90 GROUP BY ALL")
def a12(spark, d):
    x = frames(spark, d).withColumns({"value": weather.sentinels_to_null(F.col("value")), "slot": align.snap(F.col("ts"))}).where("slot is not null")
    return audit.slots_per_day(x).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n_slots")


@query("n04_index_runs", f"WITH {OBS}, i AS (SELECT DISTINCT cell_id, CAST(epoch(time - TIMESTAMP '2024-01-01') // 3600 AS BIGINT) AS idx FROM obs WHERE var = 'u10'), p AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY idx) - 1 AS pos FROM i) SELECT cell_id, min(pos) AS pos_start, max(pos) + 1 AS pos_end, min(idx) AS idx_start, max(idx) + 1 AS idx_end FROM p GROUP BY cell_id, idx - pos")
def n04(spark, d):
    x = obs(spark, d).where("var = 'u10'").select("cell_id", align.position(F.col("time"), START, 3600).alias("idx"))
    return align.runs(x, "idx", "cell_id")


@query("n05_axis_blocks", f"WITH {OBS}, t AS (SELECT DISTINCT var, time FROM obs), b AS (SELECT var, time, CAST((row_number() OVER (PARTITION BY var ORDER BY time) - 1) // 100 AS BIGINT) AS block FROM t) SELECT var, block, count(*) AS n, strftime(min(time), '%Y-%m-%d %H:%M:%S') AS first_time FROM b GROUP BY ALL")
def n05(spark, d):
    x = align.blocks(obs(spark, d).select("var", "time").distinct(), 100, "time", "var")
    return x.groupBy("var", "block").agg(F.count("*").alias("n"), F.date_format(F.min("time"), "yyyy-MM-dd HH:mm:ss").alias("first_time"))


@query("n07_axis_position", f"WITH {FRAMES} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, min(CASE WHEN epoch_us(ts) // 1000000 % 3600 = 0 THEN (epoch_us(ts) // 1000000 - 1704067200) // 3600 END) AS position, max(CAST(ceil((epoch_us(ts) // 1000000 - 1704067200) / 3600) AS BIGINT)) AS insertion FROM frames GROUP BY 1")
def n07(spark, d):
    x = frames(spark, d).select("ts", align.position(F.col("ts"), START, 3600).alias("p"), align.insertion_point(F.col("ts"), START, 3600).alias("i"))
    return x.groupBy(at("ts")).agg(F.min("p").alias("position"), F.max("i").alias("insertion"))


@query("o01_sorted", f"WITH {OBS} SELECT var, strftime(min(time), '%Y-%m-%d %H:%M:%S') AS first_time, strftime(max(time), '%Y-%m-%d %H:%M:%S') AS last_time FROM obs GROUP BY var")
def o01(spark, d):
    x = obs(spark, d).sortWithinPartitions("time")
    return x.groupBy("var").agg(F.date_format(F.min("time"), "yyyy-MM-dd HH:mm:ss").alias("first_time"), F.date_format(F.max("time"), "yyyy-MM-dd HH:mm:ss").alias("last_time"))


@query("t01_full_axis", f"WITH {OBS}, b AS (SELECT min(time) AS a, max(time) AS z FROM obs), s AS (SELECT unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS time FROM b) SELECT {TIME} FROM s")
def t01(spark, d):
    b = obs(spark, d).agg(F.min("time").alias("a"), F.max("time").alias("z"))
    return b.select(F.explode(F.expr("sequence(a, z, interval 1 hour)")).alias("time")).select(at())


@query("t09_standard_calendar", f"WITH {OBS}, n AS (SELECT time + INTERVAL 46 DAY AS time, cell_id, value FROM obs WHERE var = 'u10' AND CAST(time + INTERVAL 46 DAY AS DATE) <> DATE '2024-02-29'), sp AS (SELECT unnest(generate_series(TIMESTAMP '2024-02-27', TIMESTAMP '2024-03-02 23:00:00', INTERVAL 1 HOUR)) AS time), c AS (SELECT DISTINCT cell_id FROM n) SELECT strftime(sp.time, '%Y-%m-%d %H:%M:%S') AS time, c.cell_id, round(n.value, 6) AS value FROM sp CROSS JOIN c LEFT JOIN n ON n.time = sp.time AND n.cell_id = c.cell_id")
def t09(spark, d):
    x = obs(spark, d).where("var = 'u10'").withColumn("time", F.expr("time + interval 46 days")).where("to_date(time) <> date'2024-02-29'")
    x = x.select(F.year("time").alias("year"), F.month("time").alias("month"), F.dayofmonth("time").alias("day"), F.hour("time").alias("hour"), "cell_id", "value")
    return align.standard_calendar(x, align.axis(spark, "2024-02-27 00:00:00", "2024-03-02 23:00:00"), "cell_id").select(at(), "cell_id", r6("value"))


@query("t10_axis_without_leap_day", f"WITH {OBS}, s AS (SELECT unnest(generate_series(TIMESTAMP '2024-02-25', TIMESTAMP '2024-03-03', INTERVAL 1 HOUR)) AS time), h AS (SELECT hour(time) AS h, count(*) AS n_obs FROM obs GROUP BY ALL) SELECT strftime(s.time, '%Y-%m-%d %H:%M:%S') AS time, n_obs FROM s JOIN h ON hour(s.time) = h.h WHERE NOT (month(time) = 2 AND day(time) = 29)")
def t10(spark, d):
    x = align.without_leap_days(align.axis(spark, "2024-02-25 00:00:00", "2024-03-03 00:00:00"))
    h = obs(spark, d).groupBy(F.hour("time").alias("h")).agg(F.count("*").alias("n_obs"))
    return x.join(h, F.hour("time") == F.col("h")).select(at(), "n_obs")


@query("t14_day_slots", f"WITH {FRAMES}, d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM frames) SELECT strftime(day, '%Y-%m-%d') AS day, 288 AS n_slots FROM d")
def t14(spark, d):
    days = frames(spark, d).select(F.to_date("ts").alias("day")).distinct()
    x = days.withColumn("slot", F.explode(F.expr("sequence(cast(day as timestamp), cast(day as timestamp) + interval 1435 minutes, interval 5 minutes)")))
    return x.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count("slot").cast("int").alias("n_slots"))


DIR = "CASE WHEN u10 IS NULL OR v10 IS NULL THEN NULL WHEN u10 = 0 AND v10 = 0 THEN {calm} ELSE (((270 - degrees(atan2(v10, u10))) % 360) + 360) % 360 END"


@query("f01_wind_speed", f"WITH {WIDE} SELECT {TIME}, cell_id, round(sqrt(u10 * u10 + v10 * v10), 6) AS si10 FROM wide")
def f01(spark, d):
    return obs_wide(spark, d).select(at(), "cell_id", r6(weather.wind_speed(F.col("u10"), F.col("v10")), "si10"))


@query("f02_wind_direction", f"WITH {WIDE} SELECT {TIME}, cell_id, round({DIR.format(calm=0)}, 6) AS wdir10 FROM wide")
def f02(spark, d):
    return obs_wide(spark, d).select(at(), "cell_id", r6(weather.wind_direction(F.col("u10"), F.col("v10")), "wdir10"))


@query("f03_wind_direction_calm_270", f"WITH {WIDE} SELECT {TIME}, cell_id, round({DIR.format(calm=270)}, 6) AS wdir10 FROM (SELECT time, cell_id, round(u10) AS u10, round(v10) AS v10 FROM wide)")
def f03(spark, d):
    x = obs_wide(spark, d).withColumns({"u10": F.round("u10"), "v10": F.round("v10")})
    return x.select(at(), "cell_id", r6(weather.wind_direction(F.col("u10"), F.col("v10"), None), "wdir10"))


@query("f04_total_precipitation", f"WITH {WIDE} SELECT {TIME}, cell_id, round(tp * 0.75 + tp * 0.25, 6) AS total FROM wide")
def f04(spark, d):
    return obs_wide(spark, d).select(at(), "cell_id", r6(weather.total_precipitation(F.col("tp") * 0.75, F.col("tp") * 0.25), "total"))


@query("f24_log10_1p", f"WITH {WIDE} SELECT {TIME}, cell_id, round(log10(1 + tp), 6) AS log_tp FROM wide WHERE tp IS NOT NULL")
def f24(spark, d):
    return obs_wide(spark, d).where("tp is not null").select(at(), "cell_id", r6(weather.log10_1p(F.col("tp")), "log_tp"))


UNITS = OBS + ", u AS (SELECT *, CASE var WHEN 'tp' THEN CASE cell_id % 4 WHEN 0 THEN 'm' WHEN 1 THEN 'mm' WHEN 2 THEN ' KG  m-2' ELSE 'kg m-2 s-1' END ELSE CASE cell_id % 3 WHEN 0 THEN 'm/s' WHEN 1 THEN 'M s-1' ELSE '' END END AS units FROM obs)"


def _with_units(spark, d):
    tp = F.when(F.col("cell_id") % 4 == 0, "m").when(F.col("cell_id") % 4 == 1, "mm").when(F.col("cell_id") % 4 == 2, " KG  m-2").otherwise("kg m-2 s-1")
    wind = F.when(F.col("cell_id") % 3 == 0, "m/s").when(F.col("cell_id") % 3 == 1, "M s-1").otherwise("")
    return obs(spark, d).withColumn("units", F.when(F.col("var") == "tp", tp).otherwise(wind))


@query("f10_normal_units", f"WITH {UNITS} SELECT var, units, CASE lower(regexp_replace(trim(units), '\\s+', ' ', 'g')) WHEN 'm/s' THEN 'm s**-1' WHEN 'm s-1' THEN 'm s**-1' WHEN 'kg m-2' THEN 'kg m**-2' ELSE units END AS canonical, count(*) AS n FROM u GROUP BY ALL")
def f10(spark, d):
    return _with_units(spark, d).groupBy("var", "units", units.normal_units(F.col("units")).alias("canonical")).agg(F.count("*").alias("n"))


@query("f11_convert_units", f"WITH {UNITS} SELECT var, {TIME}, cell_id, round(value * CASE WHEN var = 'tp' THEN [1000.0, 1.0, 1.0, 3600.0][1 + cell_id % 4] ELSE 1.0 END, 6) AS value, CASE var WHEN 'tp' THEN 'kg m**-2' ELSE 'm s**-1' END AS units, CASE var WHEN 'tp' THEN 'total precipitation' WHEN 'u10' THEN '10 m eastward wind' ELSE '10 m northward wind' END AS long_name FROM u")
def f11(spark, d):
    return units.convert(_with_units(spark, d)).select("var", at(), "cell_id", r6("value"), "units", "long_name")


@query("f12_source_units", f"WITH {UNITS} SELECT var, cell_id, CASE WHEN cell_id = 23 THEN 'forced' WHEN trim(units) <> '' THEN units WHEN var = 'u10' THEN 'm s-1' END AS source_units, count(*) AS n FROM u GROUP BY ALL")
def f12(spark, d):
    x = _with_units(spark, d).withColumn("override", F.when(F.col("cell_id") == 23, "forced"))
    return x.groupBy("var", "cell_id", units.source_units(F.col("units"), F.col("var"), {"u10": "m s-1"}, F.col("override")).alias("source_units")).agg(F.count("*").alias("n"))


@query("f13_attributes", f"WITH {OBS} SELECT var, CASE var WHEN 'tp' THEN 'kg m**-2' ELSE 'm s**-1' END AS units, CASE var WHEN 'tp' THEN 'total precipitation' WHEN 'u10' THEN '10 m eastward wind' ELSE '10 m northward wind' END AS long_name, 'NaN' AS missing_value, count(*) AS n, round(sum(value * CASE var WHEN 'tp' THEN 1000 ELSE 1 END), 4) AS total FROM obs GROUP BY var")
def f13(spark, d):
    """The attributes that columns carry once they are stamped, and their values in canonical units."""
    x = units.stamped(obs_wide(spark, d), {"tp": "m", "u10": "m/s"})
    attrs = [(v, *(x.schema[v].metadata[k] for k in ("units", "long_name", "missing_value"))) for v in VARS]
    of = F.broadcast(spark.createDataFrame(attrs, "var string, units string, long_name string, missing_value string"))  # a row for each variable
    return stats.long(x, VARS).join(of, "var").groupBy("var", "units", "long_name", "missing_value").agg(F.count("*").alias("n"), r6(F.sum("value"), "total", 4))


@query("t11_decode_time", "WITH e AS (SELECT event_id, user_id FROM events) SELECT event_id, strftime(CASE user_id % 3 WHEN 0 THEN make_timestamp(1704067200000000 + event_id * 1000000) WHEN 1 THEN TIMESTAMP '2018-01-01' + to_minutes(event_id) ELSE TIMESTAMP '2018-01-01' + to_hours(event_id) END, '%Y-%m-%d %H:%M:%S') AS time FROM e")
def t11(spark, d):
    from .views import table

    e = table(spark, d, "events")
    kind = F.col("user_id") % 3
    raw = F.when(kind == 0, 1704067200000000000 + F.col("event_id") * 1000000000).otherwise(F.col("event_id"))
    unit = F.when(kind == 0, "").when(kind == 1, "minutes since 2018-01-01 00:00:00").otherwise("hours since 2018-01-01 00:00:00")
    return e.select("event_id", units.decode_time(raw, unit).alias("time")).select("event_id", at())


@query("x02_slots_as_batch", f"WITH {SLOTTED}, h AS (SELECT *, row_number() OVER (PARTITION BY slot, cell_id ORDER BY gap, ts DESC) AS r FROM s WHERE gap <= 120000000) SELECT strftime(slot, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 4) AS total FROM h WHERE r = 1 GROUP BY ALL")
def x02(spark, d):
    from ..streaming.frames import slot_stream

    x = slot_stream(frames(spark, d))
    return x.groupBy(F.date_format("slot", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), r6(F.sum("value"), "total", 4))


@query("u05_derived_when_complete", f"WITH {WIDE}, c AS (SELECT CAST(time AS DATE) AS day, count(u10) AS nu, count(v10) AS nv FROM wide GROUP BY ALL) SELECT strftime(w.time, '%Y-%m-%d %H:%M:%S') AS time, w.cell_id, round(sqrt(u10 * u10 + v10 * v10), 6) AS si10 FROM wide w JOIN c ON CAST(w.time AS DATE) = c.day WHERE nu >= 200 AND nv >= 200 AND u10 IS NOT NULL AND v10 IS NOT NULL")
def u05(spark, d):
    from ..functions.derived import derive_when_complete

    return derive_when_complete(obs(spark, d), "si10", 200).select(at(), "cell_id", r6("value", "si10"))


@query("x01_incremental_ingest", f"WITH {SLOTTED}, h AS (SELECT *, row_number() OVER (PARTITION BY slot, cell_id ORDER BY gap, ts DESC) AS r FROM s WHERE gap <= 120000000) SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, cell_id, value FROM h WHERE r = 1")
def x01(spark, d):
    """Frames that have arrived go through slots into a store by a stream that ends when nothing is left."""
    from ..streaming.frames import ingest

    root = sinks.scratch(spark, "ingest")
    kept = store.Store(spark, f"{root}/store", store.Axis(START, "2024-01-31 00:00:00", "5 minutes"))
    put = lambda df: kept.upsert(df.select(F.lit("radar").alias("product"), F.lit("rate").alias("var"), F.col("slot").alias("time"), "cell_id", "value", "frame_time"), nearest=True)
    frames(spark, d).write.parquet(f"{root}/landed")
    arriving = spark.readStream.schema(frames(spark, d).schema).parquet(f"{root}/landed")
    ingest(arriving, put, f"{root}/checkpoint").awaitTermination()
    return kept.open("radar").select(at("time").alias("slot"), "cell_id", F.round(F.col("value").cast("double"), 2).alias("value"))


@query("w13_audit_output", f"WITH {MISSING} SELECT var, {TIME}, n FROM m WHERE var = 'tp'")
def w13(spark, d):
    path = sinks.scratch(spark, "audit")
    sinks.write_result(audit.missing_times(obs(spark, d), spine(spark), CELLS, ["tp"]).select("var", at(), "n"), path)
    return spark.read.parquet(path)
