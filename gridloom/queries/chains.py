"""Whole product chains: operators in the order a product needs them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import products
from .observations import MISSING, SLOTTED, spine
from .views import CYCLES, GRID, LEVELS, OBS, SPINE, WIDE, at, cycles, frames, grid, lat_step, levels, obs, r6, register, regular_grid

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)

DAILY = f"""WITH {WIDE}, {GRID}, {SPINE},
box AS (SELECT cell_id FROM grid WHERE latitude BETWEEN 38 AND 48 AND longitude BETWEEN 278 AND 292),
w AS (SELECT time, cell_id, sqrt(u10 * u10 + v10 * v10) AS si10, u10, v10 FROM wide JOIN box USING (cell_id) WHERE u10 IS NOT NULL AND v10 IS NOT NULL),
s AS (SELECT spine.time, box.cell_id FROM spine CROSS JOIN box)
SELECT strftime(s.time, '%Y-%m-%d') AS day, s.cell_id, round(avg(si10), 6) AS si10, round(avg(u10), 6) AS u10, round(avg(v10), 6) AS v10, count(si10) AS n_hours,
  CASE WHEN count(si10) = 0 THEN 'empty' WHEN count(si10) < 24 THEN 'partial' ELSE 'full' END AS status
FROM s LEFT JOIN w ON w.time = s.time AND w.cell_id = s.cell_id GROUP BY ALL"""


@query("q01_daily_wind_in_box", DAILY)
def daily_wind(spark, d) -> DataFrame:
    x = products.daily_wind(obs(spark, d), grid(spark, d), "2024-01-01", "2024-01-30", (38.0, 48.0, -82.0, -68.0))
    return x.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "cell_id", r6("si10"), r6("u10"), r6("v10"), "n_hours", "status")


@query(
    "q02_forecast_month",
    """WITH c AS (SELECT o_orderdate AS init_time, o_orderkey % 3 + 1 AS lead_hour, o_custkey % 50 AS cell_id, avg(o_totalprice) AS value FROM orders GROUP BY ALL),
v AS (SELECT init_time + to_hours(lead_hour) AS time, cell_id, value FROM c)
SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS time, cell_id, round(value * 1000, 4) AS value, 'kg m**-2' AS units FROM v WHERE strftime(time, '%Y-%m') = '1997-07'""",
)
def forecast_month(spark, d):
    x = products.forecast_month(cycles(spark, d), "1997-07", "tp", "m", longest=3)
    return x.select(at(), "cell_id", r6("value", digits=4), "units")


@query(
    "q03_frames_to_slots",
    f"""WITH {SLOTTED}, h AS (SELECT *, row_number() OVER (PARTITION BY slot, cell_id ORDER BY gap, ts DESC) AS r FROM s WHERE gap <= 120000000),
v AS (SELECT slot, cell_id, CASE WHEN value >= -90 THEN value END AS value FROM h WHERE r = 1),
p AS (SELECT unnest(range(0, 11)) AS dst, round(1.0::DOUBLE / 3.0::DOUBLE, 9) AS t, round(0.1::DOUBLE / 0.45::DOUBLE, 9) AS u),
c AS (SELECT dst, a * 12 + dst + b AS src, (CASE a WHEN 1 THEN t ELSE 1 - t END) * (CASE b WHEN 1 THEN u ELSE 1 - u END) AS w FROM p, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b))
SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, dst AS cell_id, round(CASE WHEN count(value) = 4 THEN sum(value * w) END, 4) AS value FROM v JOIN c ON v.cell_id = c.src GROUP BY ALL""",
)
def frames_to_slots(spark, d):
    g = regular_grid(spark, d).where("y < 2")
    small = g.where("x < 12").withColumn("cell_id", (F.col("y") * 12 + F.col("x")).cast("long"))
    points = small.select(F.col("cell_id").alias("dst_cell"), (F.col("latitude") + lat_step(spark, d) / 3).alias("latitude"), (F.col("longitude") + 0.1).alias("longitude"))
    x = products.frames_to_slots(frames(spark, d), small, points)
    return x.select(at("slot"), "cell_id", r6("value", digits=4))


@query("q04_statistics", f"WITH {OBS}, {GRID}, b AS (SELECT o.* FROM obs o JOIN grid USING (cell_id) WHERE latitude BETWEEN 38 AND 48 AND longitude BETWEEN 278 AND 292 AND time >= '2024-01-02' AND time < '2024-01-29') SELECT var, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 4) AS std FROM (SELECT var, value FROM b UNION ALL SELECT 'log_tp', log10(1 + value) FROM b WHERE var = 'tp') GROUP BY var")
def statistics(spark, d):
    x = products.statistics(obs(spark, d), grid(spark, d), "2024-01-02", "2024-01-28", (38.0, 48.0, -82.0, -68.0))
    return x.select("var", r6("min"), r6("max"), r6("mean"), r6("std", digits=4))


@query("q05_pressure_columns", f"WITH {LEVELS}, u AS (SELECT time, cell_id, max(CASE WHEN var = 'u' AND level = 500 THEN value END) AS u_500hpa, max(CASE WHEN var = 'u' AND level = 850 THEN value END) AS u_850hpa, max(CASE WHEN var = 'v' AND level = 500 THEN value END) AS v_500hpa, max(CASE WHEN var = 'v' AND level = 850 THEN value END) AS v_850hpa FROM levels WHERE var IN ('u', 'v') AND level IN (500, 850) GROUP BY ALL), s AS (SELECT time, cell_id, value AS t2m FROM levels WHERE level = 1000 AND var = 't') SELECT strftime(coalesce(u.time, s.time), '%Y-%m-%d %H:%M:%S') AS time, coalesce(u.cell_id, s.cell_id) AS cell_id, round(u_500hpa, 6) AS u_500hpa, round(u_850hpa, 6) AS u_850hpa, round(v_500hpa, 6) AS v_500hpa, round(v_850hpa, 6) AS v_850hpa, round(t2m, 6) AS t2m FROM u FULL JOIN s ON u.time = s.time AND u.cell_id = s.cell_id")
def pressure_columns(spark, d):
    x = products.pressure_columns(levels(spark, d), ["u", "v"], [500, 850], 1000, "t2m")
    return x.select(at(), "cell_id", *(r6(c) for c in x.columns if c not in ("time", "cell_id")))


@query("q06_mesh_month", f"WITH {CYCLES}, {GRID} SELECT strftime(init_time + to_hours(lead_hour), '%Y-%m-%d %H:%M:%S') AS time, cell_id, round(value * 100, 4) AS value, 'Pa' AS units FROM cycles WHERE strftime(init_time + to_hours(lead_hour), '%Y-%m') = '1998-02' AND cell_id IN (SELECT cell_id FROM grid WHERE field > 0)")
def mesh_month(spark, d):
    mask = grid(spark, d).select("cell_id", (F.col("field") > 0).alias("mask"))
    x = products.mesh_month(cycles(spark, d), mask, "1998-02", "sp", "hPa", longest=3)
    return x.select(at(), "cell_id", r6("value", digits=4), "units")


@query("q07_gap_report", f"WITH {MISSING} SELECT var, CAST(year(time) AS INTEGER) AS year, 720::BIGINT AS n_times, count(*) AS n_missing FROM m GROUP BY ALL")
def gap_report(spark, d):
    return products.gap_report(obs(spark, d), spine(spark), 24, ["u10", "v10", "tp"])
