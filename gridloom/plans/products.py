"""Product chains, each a composition of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derived import with_derived
from ..functions.units import convert
from ..functions.weather import sentinels_to_null
from ..operators import align, regrid, select, stats

Box = tuple[float, float, float, float]


def daily_wind(obs: DataFrame, grid: DataFrame, start: str, end: str, box: Box) -> DataFrame:
    """(day, cell_id, si10, u10, v10, n_hours, status): daily means in a box, hours without both winds counted as missing.

    Cells of the box and days of the axis are few, and their product is the result; observations meet the cells once and are counted by day, so the
    complete axis is laid beside daily rows, not hourly ones.
    """
    cells = select.crop_box(grid, *box).select("cell_id")
    x = select.time_range(obs.where(F.col("var").isin("u10", "v10")), start, end).join(cells, "cell_id", "left_semi")
    w = with_derived(stats.wide(x, ["u10", "v10"]).dropna(subset=["u10", "v10"]), "si10")
    per_day = w.groupBy(F.to_date("time").alias("day"), "cell_id").agg(*(F.avg(c).alias(c) for c in ("si10", "u10", "v10")), F.count("si10").alias("n"))
    days = obs.sparkSession.range(1).select(F.explode(F.expr(f"sequence(date'{start}', date'{end}', interval 1 day)")).alias("day"))
    full = cells.join(F.broadcast(days)).join(per_day, ["day", "cell_id"], "left")
    n = F.coalesce("n", F.lit(0))
    status = F.when(n == 0, "empty").when(n < 24, "partial").otherwise("full")
    return full.select("day", "cell_id", "si10", "u10", "v10", n.alias("n_hours"), status.alias("status"))


def forecast_month(cycles: DataFrame, month: str, var: str, units: str, longest: int | None = None) -> DataFrame:
    """(time, cell_id, var, value, units, long_name) of forecast cycles by valid time, in canonical units."""
    x = align.valid_time(cycles, month=month, longest=longest).select("time", "cell_id", F.lit(var).alias("var"), "value", F.lit(units).alias("units"))
    return convert(x)


def frames_to_slots(frames: DataFrame, source: DataFrame, points: DataFrame) -> DataFrame:
    """(slot, cell_id, value): irregular frames in 5-minute slots, sentinels missing, on target points."""
    x = align.snapped_frames(frames).withColumn("value", sentinels_to_null(F.col("value")))
    return regrid.regrid(x, regrid.bilinear_weights(source, points), "slot")


def statistics(obs: DataFrame, grid: DataFrame, start: str, end: str, box: Box) -> DataFrame:
    """Summaries of the observations in a box and period."""
    cells = select.crop_box(grid, *box).select("cell_id")
    return stats.summary(select.time_range(obs, start, end).join(cells, "cell_id", "left_semi"))


def pressure_columns(levels: DataFrame, variables: list[str], wanted: list[int], surface_level: int, surface_name: str) -> DataFrame:
    """(time, cell_id, <var>_<level>hpa ..., surface): pressure levels as columns, beside the surface variable."""
    upper = stats.pivot_levels(select.select_levels(levels.where(F.col("var").isin(variables)), wanted), variables, wanted)
    surface = levels.where((F.col("level") == surface_level) & (F.col("var") == "t")).select("time", "cell_id", F.col("value").alias(surface_name))
    return align.merge_first(upper, surface, "time", "cell_id")


def mesh_month(cycles: DataFrame, mask: DataFrame, month: str, var: str, units: str, longest: int | None = None) -> DataFrame:
    """(time, cell_id, value, units) of the masked nodes of a mesh: cycles by valid time, one month, in canonical units."""
    x = select.crop_mask(align.valid_time(cycles, month=month, longest=longest), mask)
    return convert(x.select("time", "cell_id", F.lit(var).alias("var"), "value", F.lit(units).alias("units")))


def gap_report(obs: DataFrame, spine: DataFrame, n_cells: int, variables: list[str]) -> DataFrame:
    """(var, year, n_times, n_missing): times of the axis, and those at which any cell lacks a value."""
    from ..operators import audit

    missing = audit.missing_by_year(audit.missing_times(obs, spine, n_cells, variables))
    covered = audit.coverage_by_year(spine)
    return missing.join(F.broadcast(covered), "year").select("var", "year", "n_times", "n_missing")
