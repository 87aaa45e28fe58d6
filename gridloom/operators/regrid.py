"""Bilinear weights between grids, and fields on another grid by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.weather import albers


def bilinear_weights(source: DataFrame, points: DataFrame) -> DataFrame:
    """(dst_cell, src_cell, w): four corners of the source cell round each point (dst_cell, latitude, longitude).

    source: a regular grid (cell_id, y, x, latitude, longitude) with even steps along both axes, latitude upward or
    downward. Points outside of its hull get none. A corner on the upper edge keeps its row with weight 0, so that a
    missing corner always makes a missing value.
    """
    ends = source.agg(
        F.min_by("latitude", "y").alias("lat0"), F.max_by("latitude", "y").alias("lat1"), F.max("y").alias("ny"), F.min("y").alias("y0"),
        F.min_by("longitude", "x").alias("lon0"), F.max_by("longitude", "x").alias("lon1"), F.max("x").alias("nx"), F.min("x").alias("x0"),
    )
    fy = (F.col("latitude") - F.col("lat0")) / (F.col("lat1") - F.col("lat0")) * (F.col("ny") - F.col("y0")) + F.col("y0")
    fx = (F.col("longitude") - F.col("lon0")) / (F.col("lon1") - F.col("lon0")) * (F.col("nx") - F.col("x0")) + F.col("x0")
    p = points.join(F.broadcast(ends)).withColumns({"fy": F.round(fy, 9), "fx": F.round(fx, 9)})
    p = p.where(F.col("fy").between(F.col("y0"), F.col("ny")) & F.col("fx").between(F.col("x0"), F.col("nx")))
    p = p.withColumns({"iy": F.least(F.floor("fy"), F.col("ny") - 1), "ix": F.least(F.floor("fx"), F.col("nx") - 1)})
    ty, tx = F.col("fy") - F.col("iy"), F.col("fx") - F.col("ix")
    corners = F.array(*(F.struct((F.col("iy") + a).cast("int").alias("y"), (F.col("ix") + b).cast("int").alias("x"), ((ty if a else 1 - ty) * (tx if b else 1 - tx)).alias("w")) for a in (0, 1) for b in (0, 1)))
    c = p.select("dst_cell", F.explode(corners).alias("c")).select("dst_cell", "c.y", "c.x", "c.w")
    return c.join(source.select("y", "x", F.col("cell_id").alias("src_cell")), ["y", "x"], "left").select("dst_cell", "src_cell", "w")


def regrid(obs: DataFrame, weights: DataFrame, *keys: str, corners: int = 4) -> DataFrame:
    """(keys, cell_id, value) on the weights' target; null where any corner is."""
    x = obs.withColumnRenamed("cell_id", "src_cell").join(weights, "src_cell")
    value = F.when(F.count("value") == corners, F.sum(F.col("value") * F.col("w")))
    return x.groupBy(*keys, "dst_cell").agg(value.alias("value")).withColumnRenamed("dst_cell", "cell_id")


def regrid_frames(obs: DataFrame, weights: DataFrame, *keys: str, corners: int = 4, most_weights: int = 1_000_000) -> DataFrame:
    """regrid for series of frames: each value is shuffled once, with its frame, and corners are summed in its task.

    keys name a frame (variable, time, level), which a task must hold the sums of. Weights are read twice: to see that they
    are at most most_weights rows, so that all tasks can have them, and to be used; keep them first (mesh.kept_weights).
    More weights than that go the way of regrid, which shuffles a row a corner.
    """
    if not keys or weights.select("dst_cell").limit(most_weights + 1).count() > most_weights:
        return regrid(obs, weights, *keys, corners=corners)
    return regrid(obs.repartition(*keys), F.broadcast(weights), *keys, corners=corners)


def same_grid(a: DataFrame, b: DataFrame, fields: list[str], tolerance: float | None = None) -> DataFrame:
    """One row: whether each field is equal (or within tolerance) in all cells (y, x), and whether cells are the same."""
    x = a.select("y", "x", *(F.col(f).alias(f"a_{f}") for f in fields), F.lit(1).alias("a")).join(
        b.select("y", "x", *(F.col(f).alias(f"b_{f}") for f in fields), F.lit(1).alias("b")), ["y", "x"], "full")
    equal = lambda f: F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")) if tolerance is None else F.coalesce(F.abs(F.col(f"a_{f}") - F.col(f"b_{f}")) <= tolerance, F.lit(False))
    return x.agg(F.bool_and(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("same_cells"), *(F.bool_and(equal(f)).alias(f"same_{f}") for f in fields))


def equal_distance_bins(points: DataFrame, field: str, metres: float = 2500.0, lon: Column | None = None) -> DataFrame:
    """(bx, by, field): means over squares of an equal-area projection."""
    px, py = albers(F.col("longitude") if lon is None else lon, F.col("latitude"))
    return points.groupBy(F.floor(px / metres).alias("bx"), F.floor(py / metres).alias("by")).agg(F.avg(field).alias(field))


def combine_static(*fields: DataFrame) -> DataFrame:
    """Static fields (cell_id and own columns) side by side, all cells kept."""
    out = fields[0]
    for f in fields[1:]:
        out = out.join(f, "cell_id", "full")
    return out


def latest_first(df: DataFrame, order: str, *keys: str) -> DataFrame:
    """The row of largest order for each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
