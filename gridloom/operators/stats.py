"""Statistics of observations and grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.weather import haversine_km, log10_1p
from .align import neighbours


def summary(obs: DataFrame, logarithm_of: tuple[str, ...] = ("tp",)) -> DataFrame:
    """(var, min, max, mean, std) with the population's deviation; log_<var> rows, of log10(1 + value), for some."""
    both = obs.select("var", "value")
    if logarithm_of:
        both = both.unionByName(obs.where(F.col("var").isin(*logarithm_of)).select(F.concat(F.lit("log_"), "var").alias("var"), log10_1p(F.col("value")).alias("value")))
    return both.groupBy("var").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def percentiles(obs: DataFrame, *keys: str, approximate: bool = False) -> DataFrame:
    """(keys, percentile, value) for percentiles 1 to 100, interpolated linearly, or approximate within 1/10,000 of the rank."""
    at = ", ".join(f"{p / 100}D" for p in range(1, 101))
    f = f"percentile_approx(value, array({at}), 10000)" if approximate else f"percentile(value, array({at}))"
    x = obs.where("value is not null").groupBy(*keys).agg(F.expr(f).alias("q"))
    return x.select(*keys, F.posexplode("q").alias("percentile", "value")).withColumn("percentile", F.col("percentile") + 1)


def block_mean(grid: DataFrame, k: int, field: str) -> DataFrame:
    """(y, x, field): means of k x k cells; rows and columns beyond a multiple of k are left out, and nulls don't count."""
    size = grid.agg((F.floor((F.max("y") + 1) / k) * k).alias("_ny"), (F.floor((F.max("x") + 1) / k) * k).alias("_nx"))
    x = grid.join(F.broadcast(size), (F.col("y") < F.col("_ny")) & (F.col("x") < F.col("_nx")))
    return x.groupBy(F.floor(F.col("y") / k).alias("y"), F.floor(F.col("x") / k).alias("x")).agg(F.avg(field).alias(field))


def spacing(grid: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: median, 10th and 90th percentile of the distances (km) along x and y, and sqrt of the medians' product.

    Exact percentiles bring the different distances together in one task, which is meant for grids; approximate ones
    (within 1/10,000 of the rank) keep summaries of fixed size, for meshes of any number of nodes.
    """
    n = neighbours(grid)
    x = n.select(
        haversine_km(F.col("latitude"), F.col("longitude"), F.col("lat_x"), F.col("lon_x")).alias("dx"),
        haversine_km(F.col("latitude"), F.col("longitude"), F.col("lat_y"), F.col("lon_y")).alias("dy"),
    )
    of = "percentile_approx({0}, array(0.1D, 0.5D, 0.9D), 10000)" if approximate else "percentile({0}, array(0.1D, 0.5D, 0.9D))"
    q = x.agg(*(F.expr(of.format(c)).alias(c) for c in ("dx", "dy")))
    out = [q[c][k].alias(f"{c}_{name}") for c in ("dx", "dy") for k, name in enumerate(("p10", "med", "p90"))]
    return q.select(*out, F.sqrt(q["dx"][1] * q["dy"][1]).alias("eff"))


def scale_ratio(a: DataFrame, b: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: how many times coarser the first grid is, by spacing and by effective scale."""
    x, y = spacing(a, approximate), spacing(b, approximate)
    left, right = x.select(F.col("eff").alias("a"), F.col("dx_med").alias("ax")), y.select(F.col("eff").alias("b"), F.col("dx_med").alias("bx"))
    return left.join(F.broadcast(right)).select((F.col("a") / F.col("b")).alias("scale_eff"), (F.col("ax") / F.col("bx")).alias("scale_dx"))


def extent(grid: DataFrame) -> DataFrame:
    """One row: range of the coordinates and mean step of the longitude along x and of the latitude along y."""
    n = neighbours(grid)
    return n.agg(
        F.min("latitude").alias("lat_min"), F.max("latitude").alias("lat_max"), F.min("longitude").alias("lon_min"), F.max("longitude").alias("lon_max"),
        F.avg(F.col("lon_x") - F.col("longitude")).alias("dlon"), F.avg(F.col("lat_y") - F.col("latitude")).alias("dlat"),
    )


def pivot_levels(df: DataFrame, variables: list[str], levels: list[int], *keys: str) -> DataFrame:
    """One column <var>_<level>hpa for each variable and level, listed so that no pass looks for them."""
    names = [f"{v}_{p}hpa" for v in variables for p in levels]
    name = F.concat("var", F.lit("_"), F.col("level").cast("int"), F.lit("hpa"))
    return df.withColumn("_name", name).groupBy(*(keys or ("time", "cell_id"))).pivot("_name", names).agg(F.first("value"))


def wide(obs: DataFrame, variables: list[str], *keys: str) -> DataFrame:
    """One column a variable."""
    return obs.groupBy(*(keys or ("time", "cell_id"))).pivot("var", variables).agg(F.first("value"))


def long(df: DataFrame, variables: list[str], *keys: str) -> DataFrame:
    """(keys, var, value) of the columns that hold a value."""
    return df.unpivot([*(keys or ("time", "cell_id"))], variables, "var", "value").where("value is not null")
