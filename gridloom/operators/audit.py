"""Completeness, presence, gaps and file audits: counts against expected numbers, never time x cell products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_times(obs: DataFrame, spine: DataFrame, n_cells: int, variables: list[str]) -> DataFrame:
    """(var, time, n) of the axis' times at which any cell lacks a value, times without rows included."""
    return missing_of(obs.where(F.col("var").isin(variables)).groupBy("var", "time").agg(F.count("value").alias("n")), spine, n_cells, variables)


def missing_of(have: DataFrame, spine: DataFrame, n_cells: int, variables: list[str]) -> DataFrame:
    """missing_times from how many values there are (var, time, n)."""
    wanted = spine.select("time", F.explode(F.array(*map(F.lit, variables))).alias("var"))
    return wanted.join(have, ["var", "time"], "left").select("var", "time", F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") < n_cells)


def coverage_by_year(times: DataFrame) -> DataFrame:
    return times.groupBy(F.year("time").alias("year")).agg(F.count("*").alias("n_times"))


def missing_by_year(missing: DataFrame) -> DataFrame:
    return missing.groupBy("var", F.year("time").alias("year")).agg(F.count("*").alias("n_missing"))


def window_counts(obs: DataFrame, window: Column, *keys: str) -> DataFrame:
    """(keys, window, n): values by window."""
    return obs.groupBy(*keys, window.alias("window")).agg(F.count("value").alias("n"))


def fill_status(obs: DataFrame, windows: DataFrame, n_cells: int, variables: list[str]) -> DataFrame:
    """(var, window, n, expected, status) for each variable and window (window, n_times): missing_var, empty, partial or full."""
    return status_of(obs.groupBy("var", "window").agg(F.count("value").alias("n")), windows, n_cells, variables)


def status_of(counts: DataFrame, windows: DataFrame, n_cells: int, variables: list[str]) -> DataFrame:
    """fill_status from how many values there are (var, window, n), which are counted once."""
    known = counts.groupBy("var").agg((F.max("n") >= 0).alias("known"))  # of n too, so that both uses share one exchange
    wanted = windows.select("window", "n_times", F.explode(F.array(*map(F.lit, variables))).alias("var"))
    x = wanted.join(counts, ["var", "window"], "left").join(known, "var", "left")
    expected, n = F.col("n_times") * n_cells, F.coalesce("n", F.lit(0))
    status = F.when(F.col("known").isNull(), "missing_var").when(n == 0, "empty").when(n < expected, "partial").otherwise("full")
    return x.select("var", "window", n.alias("n"), expected.alias("expected"), status.alias("status"))


def to_redo(status: DataFrame, policy: str) -> DataFrame:
    """Windows to process again: those not full (partial), those with nothing (empty), or all (always)."""
    keep = {"partial": F.col("status") != "full", "empty": F.col("status").isin("missing_var", "empty"), "always": F.lit(True)}
    return status.where(keep[policy])


def missing_days(obs: DataFrame, days: DataFrame, time: str = "time") -> DataFrame:
    """Days (day) on which no cell has a value."""
    have = obs.where("value is not null").select(F.to_date(time).alias("day")).distinct()
    return days.join(have, "day", "left_anti")


def missing_chunks(positions: DataFrame, present: DataFrame, chunk: int, index: str = "idx", keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, chunk): chunks of a request's axis positions that aren't present, for each value of the keys that present has.

    Chunks of the axis and keys are crossed, as all of them may be missing.
    """
    wanted, have = positions.select(F.floor(F.col(index) / chunk).alias("chunk")).distinct(), present.select(*keys, "chunk").distinct()
    if keys:
        wanted = have.select(*keys).distinct().join(wanted)
    return wanted.select(*keys, "chunk").join(have, [*keys, "chunk"], "left_anti")


def slots_per_day(frames: DataFrame, slot: str = "slot") -> DataFrame:
    return frames.where("value is not null").groupBy(F.to_date(slot).alias("day")).agg(F.count_distinct(slot).alias("n_slots"))


def files_per_day(manifest: DataFrame, days: DataFrame, expected: int) -> DataFrame:
    """(day, n_files, complete) for each day."""
    have = manifest.groupBy(F.col("date").alias("day")).agg(F.count("*").alias("n_files"))
    n = F.coalesce("n_files", F.lit(0))
    return days.join(have, "day", "left").select("day", n.alias("n_files"), (n >= expected).alias("complete"))


def small_file_dates(manifest: DataFrame, below: int) -> DataFrame:
    """Dates in the names of files smaller than so many bytes."""
    date = F.regexp_extract("path", r"\d{4}-?\d{2}-?\d{2}", 0)
    return manifest.where(F.col("size") < below).select(date.alias("date")).where("date <> ''").distinct()


def axis_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Times in one axis only, with the side (left, right)."""
    left, right = a.select("time").distinct(), b.select("time").distinct()
    return left.join(right, "time", "left_anti").withColumn("side", F.lit("left")).unionByName(right.join(left, "time", "left_anti").withColumn("side", F.lit("right")))


def require_axis(a: DataFrame, b: DataFrame) -> None:
    if not axis_differences(a, b).isEmpty():
        raise ValueError("Time axes differ")


def off_axis(df: DataFrame, spine: DataFrame) -> DataFrame:
    """Times of df that the axis lacks."""
    return df.select("time").distinct().join(spine.select("time"), "time", "left_anti")


def require_subset(df: DataFrame, spine: DataFrame) -> None:
    if not off_axis(df, spine).isEmpty():
        raise ValueError("Times off the store's axis")


def require_cells(df: DataFrame, grid: DataFrame) -> None:
    """The cells of df are those of the grid, else an error."""
    a, b = df.select("cell_id").distinct(), grid.select("cell_id").distinct()
    if not a.join(b, "cell_id", "left_anti").isEmpty() or not b.join(a, "cell_id", "left_anti").isEmpty():
        raise ValueError("Cells differ from the grid's")


def empty_frames(cycles: DataFrame) -> DataFrame:
    """(init_time, lead_hour, any_missing, all_missing) of each frame."""
    n, m = F.count("value"), F.count("*")
    return cycles.groupBy("init_time", "lead_hour").agg((n < m).alias("any_missing"), (n == 0).alias("all_missing"))
