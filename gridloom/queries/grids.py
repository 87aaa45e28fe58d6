"""Grids: crops, coordinates, spacing, coarsening, regridding, static fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import weather
from ..operators import align, mesh, regrid, select, stats
from ..sources import sinks, tables
from .views import GRID, OBS, REGULAR, grid, lat_step, obs, r6, register, regular_grid

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
BOX = (40.0, 46.0, -82.0, -72.0)
INSIDE = "latitude BETWEEN 40 AND 46 AND longitude BETWEEN 278 AND 288"
HAV = "6371.0088 * 2 * atan2(sqrt(h), sqrt(1 - h))"


def _h(a: str, b: str, c: str, e: str) -> str:
    return f"(sin(radians({c} - {a}) / 2) ** 2 + cos(radians({a})) * cos(radians({c})) * sin(radians({e} - {b}) / 2) ** 2)"


@query("p05_crop_box", f"WITH {GRID} SELECT cell_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM grid WHERE {INSIDE}")
def p05(spark, d):
    return select.crop_box(grid(spark, d), *BOX).select("cell_id", r6("latitude"), r6("longitude"))


@query("p06_crop_rectangle", f"WITH {GRID}, b AS (SELECT min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM grid WHERE {INSIDE}) SELECT cell_id, y, x FROM grid, b WHERE y BETWEEN y0 AND y1 AND x BETWEEN x0 AND x1")
def p06(spark, d):
    return select.crop_rectangle(grid(spark, d), *BOX).select("cell_id", "y", "x")


@query("p07_crop_index", f"WITH {GRID} SELECT cell_id, y, x FROM grid WHERE y >= 1 AND y < 3 AND x >= 5 AND x < 31")
def p07(spark, d):
    return select.crop_index(grid(spark, d), 1, 3, 5, 31).select("cell_id", "y", "x")


@query("p08_crop_mask", f"WITH {OBS}, {GRID} SELECT cell_id, var, count(*) AS n, round(min(latitude), 6) AS latitude FROM obs JOIN grid USING (cell_id) WHERE field > 2000 GROUP BY ALL")
def p08(spark, d):
    g = grid(spark, d)
    x = select.crop_mask(obs(spark, d), g.select("cell_id", (F.col("field") > 2000).alias("mask")))
    return select.with_coordinates(x, g).groupBy("cell_id", "var").agg(F.count("*").alias("n"), r6(F.min("latitude"), "latitude"))


@query("p09_crop_halo", f"WITH {GRID}, o AS (SELECT min(latitude) AS s, max(latitude) AS n, min(longitude) AS w, max(longitude) AS e FROM grid WHERE y BETWEEN 1 AND 2 AND x BETWEEN 10 AND 20), b AS (SELECT min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM grid, o WHERE latitude BETWEEN s - 0.5 AND n + 0.5 AND longitude BETWEEN w - 0.5 AND e + 0.5) SELECT cell_id FROM grid, b WHERE y BETWEEN y0 AND y1 AND x BETWEEN x0 AND x1")
def p09(spark, d):
    g = grid(spark, d)
    return select.crop_halo(g, g.where("y between 1 and 2 and x between 10 and 20"), 0.5).select("cell_id")


@query("p17_fill_missing", f"WITH {GRID} SELECT cell_id, round(coalesce(CASE WHEN field >= 0 THEN field END, 0.0), 6) AS field FROM grid")
def p17(spark, d):
    x = grid(spark, d).withColumn("field", F.when(F.col("field") >= 0, F.col("field")))
    return select.fill_missing(x, 0.0, "field").select("cell_id", r6("field"))


@query("p18_clip_low", f"WITH {GRID} SELECT cell_id, round(CASE WHEN f IS NOT NULL THEN greatest(f, 0) END, 6) AS field FROM (SELECT cell_id, CASE WHEN cell_id % 7 <> 0 THEN field END AS f FROM grid)")
def p18(spark, d):
    x = grid(spark, d).withColumn("field", F.when(F.col("cell_id") % 7 != 0, F.col("field")))
    return x.select("cell_id", r6(weather.clip_low(F.col("field"), 0.0), "field"))


@query("p19_coordinates", f"WITH {OBS}, {GRID} SELECT var, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude, count(*) AS n FROM obs JOIN grid USING (cell_id) GROUP BY var")
def p19(spark, d):
    x = select.with_coordinates(obs(spark, d), grid(spark, d))
    return x.groupBy("var").agg(r6(F.avg("latitude"), "latitude"), r6(F.avg("longitude"), "longitude"), F.count("*").alias("n"))


@query("s13_target_grid", f"WITH {GRID} SELECT cell_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM grid")
def s13(spark, d):
    return tables.target_grid(grid(spark, d).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})).select("cell_id", r6("latitude"), r6("longitude"))


@query("f05_geopotential_height", f"WITH {GRID} SELECT cell_id, round(greatest(field / 9.80665, 0), 6) AS height FROM grid")
def f05(spark, d):
    return grid(spark, d).select("cell_id", r6(weather.geopotential_height(F.col("field")), "height"))


@query("f06_longitude_360", f"WITH {GRID} SELECT cell_id, round((((longitude - 360) % 360) + 360) % 360, 6) AS lon FROM grid")
def f06(spark, d):
    return grid(spark, d).select("cell_id", r6(weather.longitude_360(F.col("longitude") - 360), "lon"))


@query("f07_longitude_180", f"WITH {GRID} SELECT cell_id, round((((longitude + 180) % 360) + 360) % 360 - 180, 6) AS lon FROM grid")
def f07(spark, d):
    return grid(spark, d).select("cell_id", r6(weather.longitude_180(F.col("longitude")), "lon"))


@query("f08_radians_to_degrees", f"WITH {GRID}, r AS (SELECT cell_id, radians(longitude) AS lon FROM grid), m AS (SELECT max(lon) AS m FROM r) SELECT cell_id, round(CASE WHEN m < 6.5 THEN degrees(lon) ELSE lon END, 6) AS lon FROM r, m")
def f08(spark, d):
    x = grid(spark, d).select("cell_id", F.radians("longitude").alias("lon"))
    return x.join(F.broadcast(x.agg(F.max("lon").alias("m")))).select("cell_id", r6(F.when(F.col("m") < 6.5, F.degrees("lon")).otherwise(F.col("lon")), "lon"))


@query("f09_haversine", f"WITH {GRID}, p AS (SELECT cell_id, {_h('latitude', 'longitude', '43.0', '285.0')} AS h FROM grid) SELECT cell_id, round({HAV}, 6) AS km FROM p")
def f09(spark, d):
    return grid(spark, d).select("cell_id", r6(weather.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(43.0), F.lit(285.0)), "km"))


NEXT = GRID + ", n AS (SELECT *, lead(latitude) OVER wx AS lat_x, lead(longitude) OVER wx AS lon_x, lead(latitude) OVER wy AS lat_y, lead(longitude) OVER wy AS lon_y FROM grid WINDOW wx AS (PARTITION BY y ORDER BY x), wy AS (PARTITION BY x ORDER BY y))"


@query("n01_neighbour_steps", f"WITH {NEXT} SELECT cell_id, round(lon_x - longitude, 6) AS step_x, round(lat_y - latitude, 6) AS step_y FROM n")
def n01(spark, d):
    x = align.neighbours(grid(spark, d))
    return x.select("cell_id", r6(F.col("lon_x") - F.col("longitude"), "step_x"), r6(F.col("lat_y") - F.col("latitude"), "step_y"))


@query("n02_unwrap_longitude", f"WITH {GRID} SELECT cell_id, round(350 + 0.5 * x, 6) AS lon FROM grid")
def n02(spark, d):
    x = grid(spark, d).withColumn("longitude", F.pmod(350 + F.lit(0.5) * F.col("x"), F.lit(360.0)))
    return align.unwrap(x, "lon").select("cell_id", r6("lon"))


@query("a13_block_mean", f"WITH {GRID}, s AS (SELECT (max(y) + 1) // 2 * 2 AS ny, (max(x) + 1) // 2 * 2 AS nx FROM grid) SELECT CAST(y // 2 AS BIGINT) AS y, CAST(x // 2 AS BIGINT) AS x, round(avg(field), 6) AS field FROM grid, s WHERE y < ny AND x < nx GROUP BY ALL")
def a13(spark, d):
    return stats.block_mean(grid(spark, d), 2, "field").select("y", "x", r6("field"))


SPACING = NEXT + f""", dx AS (SELECT {HAV} AS d FROM (SELECT {_h('latitude', 'longitude', 'lat_x', 'lon_x')} AS h FROM n)), dy AS (SELECT {HAV} AS d FROM (SELECT {_h('latitude', 'longitude', 'lat_y', 'lon_y')} AS h FROM n)),
q AS (SELECT (SELECT quantile_cont(d, [0.1, 0.5, 0.9]) FROM dx) AS x, (SELECT quantile_cont(d, [0.1, 0.5, 0.9]) FROM dy) AS y)"""


@query("a14_grid_spacing", f"WITH {SPACING} SELECT round(x[1], 4) AS dx_p10, round(x[2], 4) AS dx_med, round(x[3], 4) AS dx_p90, round(y[1], 4) AS dy_p10, round(y[2], 4) AS dy_med, round(y[3], 4) AS dy_p90, round(sqrt(x[2] * y[2]), 4) AS eff FROM q")
def a14(spark, d):
    x = stats.spacing(grid(spark, d))
    return x.select(*(r6(c, digits=4) for c in x.columns))


def _spacing_sql(t: str) -> str:
    """Medians of the spacing of a grid table, as <t>_m."""
    near = f"SELECT *, lead(latitude) OVER wx AS lat_x, lead(longitude) OVER wx AS lon_x, lead(latitude) OVER wy AS lat_y, lead(longitude) OVER wy AS lon_y FROM {t} WINDOW wx AS (PARTITION BY y ORDER BY x), wy AS (PARTITION BY x ORDER BY y)"
    d = lambda c: f"SELECT median({HAV}) AS d FROM (SELECT {_h('latitude', 'longitude', f'lat_{c}', f'lon_{c}')} AS h FROM {t}_n)"
    return f"{t}_n AS ({near}), {t}_m AS (SELECT x.d AS dx, sqrt(x.d * y.d) AS eff FROM ({d('x')}) x, ({d('y')}) y)"


@query("f26_scale_ratio", f"WITH {REGULAR}, coarse AS (SELECT cell_id, y // 2 AS y, x // 2 AS x, latitude, longitude FROM regular WHERE y % 2 = 0 AND x % 2 = 0), {_spacing_sql('regular')}, {_spacing_sql('coarse')} SELECT round(c.eff / r.eff, 3) AS scale_eff, round(c.dx / r.dx, 3) AS scale_dx FROM coarse_m c, regular_m r")
def f26(spark, d):
    g = regular_grid(spark, d)
    coarse = select.stride(g, 2, 2).select("cell_id", F.expr("y div 2").cast("int").alias("y"), F.expr("x div 2").cast("int").alias("x"), "latitude", "longitude")
    return stats.scale_ratio(coarse, g).select(r6("scale_eff", digits=3), r6("scale_dx", digits=3))


@query("a22_grid_extent", f"WITH {NEXT} SELECT round(min(latitude), 6) AS lat_min, round(max(latitude), 6) AS lat_max, round(min(longitude), 6) AS lon_min, round(max(longitude), 6) AS lon_max, round(avg(lon_x - longitude), 6) AS dlon, round(avg(lat_y - latitude), 6) AS dlat FROM n")
def a22(spark, d):
    x = stats.extent(grid(spark, d))
    return x.select(*(r6(c) for c in x.columns))


@query("o07_stride", f"WITH {GRID} SELECT cell_id, y, x FROM grid WHERE y % 2 = 0 AND x % 3 = 0")
def o07(spark, d):
    return select.stride(grid(spark, d), 2, 3).select("cell_id", "y", "x")


@query(
    "j12_bilinear_regrid",
    f"""WITH {REGULAR}, e AS (SELECT max(y) AS ny, max(x) AS nx FROM regular), p AS (SELECT cell_id AS dst, round((latitude + dy / 3 - 39) / dy, 9) AS fy, round((longitude + 0.2 - 276) / 0.45, 9) AS fx FROM regular, gy),
i AS (SELECT *, least(floor(fy), ny - 1) AS iy, least(floor(fx), nx - 1) AS ix FROM p, e WHERE fy BETWEEN 0 AND ny AND fx BETWEEN 0 AND nx),
c AS (SELECT dst, iy + a AS y, ix + b AS x, (CASE a WHEN 1 THEN fy - iy ELSE 1 - (fy - iy) END) * (CASE b WHEN 1 THEN fx - ix ELSE 1 - (fx - ix) END) AS w FROM i, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b))
SELECT dst AS cell_id, round(CASE WHEN count(field) = 4 THEN sum(field * w) END, 5) AS value FROM c JOIN regular r ON r.y = c.y AND r.x = c.x GROUP BY dst""",
)
def j12(spark, d):
    g = regular_grid(spark, d)
    points = g.select(F.col("cell_id").alias("dst_cell"), (F.col("latitude") + lat_step(spark, d) / 3).alias("latitude"), (F.col("longitude") + 0.2).alias("longitude"))
    x = regrid.regrid(g.select("cell_id", F.col("field").alias("value")), regrid.bilinear_weights(g, points))
    return x.select("cell_id", r6("value", digits=5))


@query(
    "j13_strided_weights",
    f"""WITH {REGULAR}, {OBS}, e AS (SELECT max(y) AS ny, max(x) AS nx FROM regular), p AS (SELECT cell_id AS dst, round((latitude - 39) / dy, 9) AS fy, round((longitude - 276) / 0.45, 9) AS fx FROM regular, gy WHERE y % 2 = 0 AND x % 2 = 0),
i AS (SELECT *, least(floor(fy), ny - 1) AS iy, least(floor(fx), nx - 1) AS ix FROM p, e),
c AS (SELECT dst, r.cell_id AS src, (CASE a WHEN 1 THEN fy - iy ELSE 1 - (fy - iy) END) * (CASE b WHEN 1 THEN fx - ix ELSE 1 - (fx - ix) END) AS w FROM i, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b), regular r WHERE r.y = iy + a AND r.x = ix + b)
SELECT strftime(o.time, '%Y-%m-%d %H:%M:%S') AS time, dst AS cell_id, round(CASE WHEN count(o.value) = 4 THEN sum(o.value * w) END, 5) AS value FROM obs o JOIN c ON o.cell_id = c.src WHERE o.var = 'u10' GROUP BY ALL""",
)
def j13(spark, d):
    from .views import at

    g = regular_grid(spark, d)
    points = select.stride(g, 2, 2).select(F.col("cell_id").alias("dst_cell"), "latitude", "longitude")
    x = regrid.regrid(obs(spark, d).where("var = 'u10'"), regrid.bilinear_weights(g, points), "time")
    return x.select(at(), "cell_id", r6("value", digits=5))


@query("j13_frames_by_kept_weights", ORACLES["j13_strided_weights"])
def j13_frames(spark, d):
    """Weights are written once; frames are laid by time, and their corners summed where they lie."""
    from .views import at

    g = regular_grid(spark, d)
    points = select.stride(g, 2, 2).select(F.col("cell_id").alias("dst_cell"), "latitude", "longitude")
    w = mesh.kept_weights(spark, f"{sinks.scratch(spark, 'weights')}/w", lambda: regrid.bilinear_weights(g, points))
    return regrid.regrid_frames(obs(spark, d).where("var = 'u10'"), w, "time").select(at(), "cell_id", r6("value", digits=5))


@query("j12_nearest_on_mesh", f"WITH {GRID}, p AS (SELECT cell_id AS dst, latitude + 0.07 AS la, longitude - 0.1 AS lo FROM grid), h AS (SELECT dst, cell_id, {_h('la', 'lo', 'latitude', 'longitude')} AS h FROM p JOIN grid ON abs(latitude - la) < 2 AND abs(longitude - lo) < 2), r AS (SELECT dst, cell_id, row_number() OVER (PARTITION BY dst ORDER BY {HAV}, cell_id) AS k FROM h) SELECT dst AS dst_cell, cell_id AS src_cell FROM r WHERE k = 1")
def j12n(spark, d):
    g = grid(spark, d)
    points = g.select(F.col("cell_id").alias("dst_cell"), (F.col("latitude") + 0.07).alias("latitude"), (F.col("longitude") - 0.1).alias("longitude"))
    return mesh.nearest_weights(g, points, 1.0).select("dst_cell", "src_cell")


def shifted(spark, d, g: DataFrame) -> DataFrame:
    return g.select(F.col("cell_id").alias("dst_cell"), (F.col("latitude") + lat_step(spark, d) / 3).alias("latitude"), (F.col("longitude") + 0.2).alias("longitude"))


@query(
    "j12_curvilinear_regrid",
    f"""WITH {GRID}, p AS (SELECT cell_id AS dst, (longitude + 0.2 - 276) / 0.45 AS fx, (latitude + dy / 3 - 39 - 0.01 * ((longitude + 0.2 - 276) / 0.45)) / dy AS fy FROM grid, gy),
i AS (SELECT *, floor(fy) AS iy, floor(fx) AS ix FROM p),
c AS (SELECT dst, field, (CASE a WHEN 1 THEN fy - iy ELSE 1 - (fy - iy) END) * (CASE b WHEN 1 THEN fx - ix ELSE 1 - (fx - ix) END) AS w FROM i, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b), grid r WHERE r.y = iy + a AND r.x = ix + b)
SELECT dst AS cell_id, round(CASE WHEN count(field) = 4 THEN sum(field * w) END, 5) AS value FROM c GROUP BY dst HAVING count(*) = 4""",
)
def j12_curvilinear(spark, d):
    """A skewed mesh onto points between its nodes."""
    g = grid(spark, d)
    x = regrid.regrid(g.select("cell_id", F.col("field").alias("value")), mesh.curvilinear_weights(g, shifted(spark, d, g)))
    return x.select("cell_id", r6("value", digits=5))


@query("j13_kept_weights", ORACLES["j12_bilinear_regrid"].replace("SELECT dst AS cell_id", "SELECT 1 AS made, dst AS cell_id"))
def j13_kept(spark, d):
    """Weights are made and written by the first call and read by the second."""
    path, g, made = sinks.scratch(spark, "weights"), regular_grid(spark, d), []
    make = lambda: made.append(1) or regrid.bilinear_weights(g, shifted(spark, d, g))
    for _ in range(2):
        w = mesh.kept_weights(spark, path, make)
    return regrid.regrid(g.select("cell_id", F.col("field").alias("value")), w).select(F.lit(len(made)).alias("made"), "cell_id", r6("value", digits=5))


@query("j14_same_grid", f"WITH {REGULAR} SELECT bool_and(g.cell_id IS NOT NULL AND r.cell_id IS NOT NULL) AS same_cells, bool_and(coalesce(abs(g.latitude - r.latitude) <= 1e-12, false)) AS same_latitude, bool_and(coalesce(abs(g.longitude - r.longitude) <= 1e-12, false)) AS same_longitude FROM grid g FULL JOIN regular r ON g.y = r.y AND g.x = r.x")
def j14(spark, d):
    return regrid.same_grid(grid(spark, d), regular_grid(spark, d), ["latitude", "longitude"], 1e-12)


@query("j15_combine_static", f"WITH {GRID}, a AS (SELECT cell_id, field AS slope FROM grid WHERE cell_id % 2 = 0), b AS (SELECT cell_id, field AS orog FROM grid WHERE cell_id % 3 = 0) SELECT cell_id, round(slope, 6) AS slope, round(orog, 6) AS orog FROM a FULL JOIN b USING (cell_id)")
def j15(spark, d):
    g = grid(spark, d)
    x = regrid.combine_static(g.where("cell_id % 2 = 0").select("cell_id", F.col("field").alias("slope")), g.where("cell_id % 3 = 0").select("cell_id", F.col("field").alias("orog")))
    return x.select("cell_id", r6("slope"), r6("orog"))


K = weather.albers_constants()
ALBERS = GRID + f""", s AS (SELECT *, sin(radians(latitude)) AS s FROM grid), q AS (SELECT *, {1 - K['e2']!r} * (s / (1 - {K['e2']!r} * s * s) - ln((1 - {K['e']!r} * s) / (1 + {K['e']!r} * s)) / {2 * K['e']!r}) AS q, {K['n']!r} * radians(longitude - 360 + 96) AS theta FROM s),
a AS (SELECT *, {K['a']!r} * sqrt({K['c']!r} - {K['n']!r} * q) / {K['n']!r} AS rho FROM q)"""


@query("f25_equal_area_bins", f"WITH {ALBERS} SELECT CAST(floor(rho * sin(theta) / 100000) AS BIGINT) AS bx, CAST(floor(({K['rho0']!r} - rho * cos(theta)) / 100000) AS BIGINT) AS by, round(avg(field), 6) AS field FROM a GROUP BY ALL")
def f25(spark, d):
    x = regrid.equal_distance_bins(grid(spark, d), "field", 100_000.0, F.col("longitude") - 360)
    return x.select("bx", "by", r6("field"))


@query("w04_cells_of_grid", f"WITH {OBS}, {GRID} SELECT 'missing' AS side, cell_id FROM grid WHERE cell_id NOT IN (SELECT cell_id FROM obs) UNION ALL SELECT DISTINCT 'unknown', cell_id FROM obs WHERE cell_id NOT IN (SELECT cell_id FROM grid)")
def w04(spark, d):
    a, b = obs(spark, d).select("cell_id").distinct(), grid(spark, d).select("cell_id")
    return b.join(a, "cell_id", "left_anti").select(F.lit("missing").alias("side"), "cell_id").union(a.join(b, "cell_id", "left_anti").select(F.lit("unknown").alias("side"), "cell_id"))
