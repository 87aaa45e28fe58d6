"""Stores in numbered states: axes that grow, former states, copies; audits and statistics from summaries alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import weather
from ..operators import align, audit, summaries
from ..sources import framefiles, sinks, store, tiles
from ..streaming.frames import follow
from . import observations
from .views import CELLS, END, FRAMES, OBS, SPINE, START, TIME, at, frames, obs, r6, register, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
VARS = observations.VARS
FLOATS = OBS.replace("obs AS (", "raw_obs AS (") + ", obs AS (SELECT time, cell_id, var, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM raw_obs)"
HALF = "2024-01-15 23:00:00"


def station(df: DataFrame) -> DataFrame:
    return df.withColumn("product", F.lit("station"))


@query(
    "w09_extended_store",
    f"""WITH {OBS}, added AS (SELECT unnest(generate_series(TIMESTAMP '{HALF}' + INTERVAL 1 HOUR, TIMESTAMP '{END}', INTERVAL 1 HOUR)) AS time)
SELECT var, '{START}' AS start, '{END}' AS "end", '1 hour' AS step, (SELECT count(*) FROM added) AS n_added, true AS refused, count(*) AS n, count(*) FILTER (time <= TIMESTAMP '{HALF}') AS n_before FROM obs GROUP BY var""",
)
def w09_store(spark, d):
    """A store of half a month gets a longer axis, then the rest; its former axis is refused and its former state still read."""
    x, path = station(obs(spark, d)), f"{sinks.scratch(spark, 'extended')}/store"
    first = store.Store(spark, path, store.Axis(START, HALF))
    first.upsert(x.where(F.col("time") <= F.lit(HALF).cast("timestamp")))
    before = first.at(first.state().version)
    n_added = first.extend(END, dry_run=True).count()
    first.extend(END).upsert(x.where(F.col("time") > F.lit(HALF).cast("timestamp")))
    try:
        first.upsert(x.limit(1))
        refused = False
    except ValueError:
        refused = True
    again = store.Store(spark, path, store.Axis(START, END))
    count = lambda s, name: s.open("station").groupBy("var").agg(F.count("*").alias(name))
    out = again.described().join(count(again, "n"), "var").join(count(before, "n_before"), "var")
    return out.select("var", "start", "end", "step", F.lit(n_added).cast("long").alias("n_added"), F.lit(refused).alias("refused"), "n", "n_before")


@query(
    "w05_former_states",
    f"""WITH {OBS}, n AS (SELECT var, time, cell_id, value + 1 AS value FROM obs WHERE var = 'tp')
SELECT version, var, count(*) AS n, round(sum(value), 2) AS total FROM (SELECT 1 AS version, * FROM (SELECT var, value FROM obs) UNION ALL SELECT 2, var, value FROM obs WHERE var <> 'tp' UNION ALL SELECT 2, var, value FROM n) GROUP BY ALL""",
)
def w05_states(spark, d):
    """Each state of a store is read as it was; an upsert of one variable leaves the folders of the others."""
    kept = observations.stored(spark, d, obs(spark, d))
    kept.upsert(station(obs(spark, d).where("var = 'tp'").withColumn("value", F.col("value") + 1)))
    of = lambda v: kept.at(v).open("station").select(F.lit(v).alias("version"), "var", "value")
    return of(1).unionByName(of(2)).groupBy("version", "var").agg(F.count("*").alias("n"), r6(F.sum(F.col("value").cast("double")), "total", 2))


@query("w11_copied_range", f"WITH {FLOATS} SELECT {TIME}, cell_id, var, round(value, 3) AS value FROM obs WHERE var IN ('u10', 'tp') AND time BETWEEN '2024-01-03 06:00:00' AND '2024-01-04 18:00:00'")
def w11_copied(spark, d):
    other = store.Store(spark, f"{sinks.scratch(spark, 'copy')}/store", store.Axis(START, END))
    observations.stored(spark, d, obs(spark, d)).copy_to(other, "2024-01-03 06:00:00", "2024-01-04 18:00:00", ["u10", "tp"])
    return other.open("station").select(at(), "cell_id", "var", r6(F.col("value").cast("double"), "value", 3))


@query("w10_merged_store", f"WITH {OBS} SELECT var, count(*) AS n, count(DISTINCT time) AS n_times, 3 AS n_states FROM obs GROUP BY var")
def w10_store(spark, d):
    """Parts of a period come as upserts, each a state; the newest holds all."""
    kept = store.Store(spark, f"{sinks.scratch(spark, 'parts')}/store", store.Axis(START, END))
    x = station(obs(spark, d))
    for k in range(3):
        kept.upsert(x.where(F.expr(f"day(time) div 11 = {k}")))
    n = len(kept.commits.versions())
    return kept.open().groupBy("var").agg(F.count("*").alias("n"), F.count_distinct("time").alias("n_times"), F.lit(n).alias("n_states"))


def bits(spark, d) -> DataFrame:
    """Presence bitmaps of a new store of observations, once written."""
    return observations.stored(spark, d, obs(spark, d)).summary("presence", "station")


def _status(spark, d) -> DataFrame:
    days = align.axis(spark, START, "2024-01-31 00:00:00", "1 day").select(F.to_date("time").alias("window"), F.lit(24).alias("n_times"))
    counts = summaries.present(bits(spark, d).withColumn("window", F.to_date("time")), "var", "window")
    return audit.status_of(counts, days, CELLS, ["u10", "tp", "sp"])


@query("a04_bitmaps_missing_times", observations.ORACLES["a04_missing_times"])
def a04(spark, d):
    return audit.missing_of(summaries.present(bits(spark, d), "var", "time"), observations.spine(spark), CELLS, VARS).select("var", at(), "n")


@query("a07_bitmaps_to_redo", observations.ORACLES["a07_windows_to_redo"])
def a07(spark, d):
    st = _status(spark, d)
    of = lambda p: audit.to_redo(st, p).select(F.lit(p).alias("policy"), "var", F.date_format("window", "yyyy-MM-dd").alias("win"))
    return of("partial").union(of("empty")).union(of("always"))


@query("a08_bitmaps_days_with_data", observations.ORACLES["a08_days_with_data"])
def a08(spark, d):
    x = summaries.present(bits(spark, d).withColumn("win", F.date_format("time", "yyyy-MM-dd")), "var", "win")
    return x.select("var", "win", (F.col("n") > 0).alias("present"))


@query("a09_bitmaps_fill_status", observations.ORACLES["a09_fill_status"])
def a09(spark, d):
    return _status(spark, d).select("var", F.date_format("window", "yyyy-MM-dd").alias("win"), "n", "expected", "status")


@query("a11_bitmaps_missing_chunks", observations.ORACLES["a11_missing_chunks"])
def a11(spark, d):
    idx = align.position(F.col("time"), START, 3600)
    ever = summaries.cells_ever(bits(spark, d).withColumn("chunk", F.floor(idx / 6)), "var", "chunk")
    return audit.missing_chunks(observations.spine(spark).select(idx.alias("idx")), summaries.cells_of(ever, "var", "chunk"), 6, keys=("var", "cell_id"))


def slot_bits(spark, d) -> DataFrame:
    """Presence bitmaps of a store of 5-minute slots."""
    kept = store.Store(spark, f"{sinks.scratch(spark, 'slots')}/store", store.Axis(START, "2024-02-05 00:00:00", "5 minutes"))
    x = frames(spark, d).withColumn("value", weather.sentinels_to_null(F.col("value"))).where("value is not null")
    kept.upsert(align.snapped_frames(x).withColumnRenamed("slot", "time").withColumns({"product": F.lit("radar"), "var": F.lit("rate")}))
    return kept.summary("presence")


DAYS = f"WITH {observations.SLOTTED}, k AS (SELECT CAST(slot AS DATE) AS day, count(DISTINCT slot) AS n_slots FROM s WHERE gap <= 120000000 AND value >= -90 GROUP BY ALL)"


@query("a10_bitmaps_missing_days", f"{DAYS}, d AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS day) SELECT strftime(day, '%Y-%m-%d') AS day FROM d WHERE day NOT IN (SELECT day FROM k)")
def a10(spark, d):
    days = align.axis(spark, START, "2024-02-05 00:00:00", "1 day").select(F.to_date("time").alias("day"))
    have = slot_bits(spark, d).select(F.to_date("time").alias("day")).distinct()
    return days.join(have, "day", "left_anti").select(F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("a12_bitmaps_slots_per_day", f"{DAYS} SELECT strftime(day, '%Y-%m-%d') AS day, n_slots FROM k")
def a12(spark, d):
    x = slot_bits(spark, d).select("time").distinct()  # groups, levels and blocks aside
    return x.groupBy(F.date_format("time", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n_slots"))


@query("a01_merged_moments", f"WITH {FLOATS} SELECT var, count(*) AS n, round(min(value), 4) AS min, round(max(value), 4) AS max, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std FROM obs GROUP BY var")
def a01(spark, d):
    """A period's statistics from the moments of its parts, which were written as two states."""
    kept = observations.stored(spark, d, obs(spark, d).where("time < timestamp'2024-01-10 00:00:00'"))
    kept.summary("moments")
    kept.upsert(station(obs(spark, d).where("time >= timestamp'2024-01-10 00:00:00'")))
    return summaries.merged_moments(kept.summary("moments"), "var").select("var", "n", r6("min", digits=4), r6("max", digits=4), r6("mean", digits=4), r6("std", digits=4))


@query("a02_merged_log_moments", f"WITH {FLOATS}, l AS (SELECT var, log10(1 + value) AS value FROM obs WHERE value > -1) SELECT var, count(*) AS n, round(min(value), 4) AS min, round(max(value), 4) AS max, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std FROM l GROUP BY var")
def a02(spark, d):
    days = summaries.moments(obs(spark, d).withColumns({"value": F.col("value").cast("float"), "grp": F.lit(None).cast("string"), "level": F.lit(None).cast("int")}), "var", "cell_id")
    return summaries.merged_moments(days, "var", log=True).select("var", "n", r6("min", digits=4), r6("max", digits=4), r6("mean", digits=4), r6("std", digits=4))


@query("a03_merged_sketches", f"WITH {OBS}, v AS (SELECT var, cell_id, list_sort(list(value)) AS vs FROM obs GROUP BY var, cell_id), p AS (SELECT *, unnest(range(1, 101)) AS p FROM v) SELECT var, cell_id, CAST(p AS INTEGER) AS percentile, round(vs[(len(vs) * p + 99) // 100], 9) AS value FROM p")
def a03(spark, d):
    """Percentiles of a month by cell from sketches of its thirds; a sketch of fewer values than its size is exact."""
    thirds = summaries.sketched(obs(spark, d).withColumn("part", F.expr("day(time) div 11")), "var", "cell_id", "part")
    return summaries.merged_quantiles(thirds, "var", "cell_id").select("var", "cell_id", "percentile", r6("value", digits=9))


@query("x02_late_frames", observations.ORACLES["x01_incremental_ingest"])
def x02_late(spark, d):
    """Frames arrive in an order of their own, three batches of them; each batch corrects the slots of those before."""
    root = sinks.scratch(spark, "late")
    kept = store.Store(spark, f"{root}/store", store.Axis(START, "2024-01-31 00:00:00", "5 minutes"))
    put = lambda df: kept.upsert(df.select(F.lit("radar").alias("product"), F.lit("rate").alias("var"), F.col("slot").alias("time"), "cell_id", "value", "frame_time"))
    x = frames(spark, d)
    x.withColumn("n", F.pmod(F.xxhash64("ts", "cell_id", "value"), F.lit(3))).repartition(3, "n").drop("n").write.parquet(f"{root}/landed")
    arriving = spark.readStream.schema(x.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
    follow(arriving, put, f"{root}/checkpoint", "40 days").awaitTermination()
    return kept.open("radar").select(at("time").alias("slot"), "cell_id", F.round(F.col("value").cast("double"), 2).alias("value"))


@query(
    "s08_frames_with_errors",
    f"""WITH {FLOATS}, d AS (SELECT CAST(time AS DATE) AS day, cell_id, avg(value) AS value FROM obs WHERE var = 'u10' GROUP BY ALL),
t AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-12', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT strftime(t.day, '%Y-%m-%d') AS day, c.cell_id, CASE WHEN day(t.day) NOT IN (5, 8) THEN round(CAST(CAST(d.value AS FLOAT) AS DOUBLE), 3) END AS value, CASE day(t.day) WHEN 5 THEN 'missing' WHEN 8 THEN 'unreadable' END AS error
FROM t, (SELECT DISTINCT cell_id FROM obs) c LEFT JOIN d ON d.day = t.day AND d.cell_id = c.cell_id WHERE day(t.day) IN (5, 8) OR d.value IS NOT NULL""",
)
def s08_errors(spark, d):
    """A file a day, of which one is missing and one holds no Parquet: these two are frames of nulls with the reason."""
    root = sinks.scratch(spark, "frames")
    x = obs(spark, d).where("var = 'u10'").withColumn("value", F.col("value").cast("float").cast("double"))
    days = x.groupBy(F.date_format("time", "yyyyMMdd").alias("day"), "cell_id").agg(F.avg("value").cast("double").alias("value"))
    bad = F.col("day").isin("20240105", "20240108")
    days.where(~bad).repartition("day").write.partitionBy("day").parquet(f"{root}/u10")
    days.where("day = '20240108'").coalesce(1).write.partitionBy("day").option("header", True).csv(f"{root}/u10", mode="append")
    read = framefiles.read_frames(spark, root, ["u10"], START, END, 86400, "{var}/day=%Y%m%d", 4)
    some = read.where("time >= timestamp'2024-01-03 00:00:00' and time <= timestamp'2024-01-12 00:00:00'")
    out = framefiles.null_frames(some, obs(spark, d).select("cell_id").distinct())
    error = F.when(F.col("error") == "missing", "missing").when(F.col("error").isNotNull(), "unreadable")
    return out.select(F.date_format("time", "yyyy-MM-dd").alias("day"), "cell_id", r6(F.col("value").cast("double"), "value", 3), error.alias("error"))


@query("w12_tiled_box", """SELECT strftime(ts, '%Y-%m-%d') AS day, user_id // 8 AS y, user_id % 8 AS x, count(*) AS n, round(sum(value), 4) AS total FROM events
WHERE user_id // 8 BETWEEN 2 AND 9 AND user_id % 8 BETWEEN 1 AND 5 AND ts BETWEEN TIMESTAMP '2024-01-07 06:00:00' AND TIMESTAMP '2024-01-09 18:00:00' GROUP BY ALL""")
def w12_tiled(spark, d):
    """Users as cells of a grid, written in tiles; a box of some days comes back through the tiles' ranges."""
    path = f"{sinks.scratch(spark, 'tiles')}/t"
    x = table(spark, d, "events").select(F.col("ts").alias("time"), F.expr("user_id div 8").alias("y"), (F.col("user_id") % 8).alias("x"), "value")
    tiles.write_tiles(x, path, block=4)
    box = tiles.read_box(spark, path, "2024-01-07 06:00:00", "2024-01-09 18:00:00", (2, 9), (1, 5), block=4)
    return box.groupBy(F.date_format("time", "yyyy-MM-dd").alias("day"), "y", "x").agg(F.count("*").alias("n"), r6(F.sum("value"), "total", 4))
