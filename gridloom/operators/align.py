"""Time axes, valid times, slots and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def axis(spark: SparkSession, start: str, end: str, step: str = "1 hour") -> DataFrame:
    """(time): the regular axis from start to end."""
    return spark.range(1).select(F.explode(F.expr(f"sequence(timestamp'{start}', timestamp'{end}', interval {step})")).alias("time"))


def without_leap_days(spine: DataFrame) -> DataFrame:
    return spine.where(~((F.month("time") == 2) & (F.dayofmonth("time") == 29)))


def reindex(df: DataFrame, spine: DataFrame, *keys: str) -> DataFrame:
    """A row for each time of the spine, for each value of the other keys that df has; times off the axis vanish.

    The complete axis is the result, so spine and distinct keys are crossed: rows are their product, whatever df holds.
    """
    if keys:
        spine = spine.join(df.select(*keys).distinct())
    return spine.join(df, ["time", *keys], "left")


def position(time: Column, start: str, step_seconds: int) -> Column:
    """Place of a time on an axis; null when it lies between its steps."""
    gap = F.unix_seconds(time) - F.unix_seconds(F.lit(start).cast("timestamp"))
    return F.when(gap % step_seconds == 0, (gap / step_seconds)).cast("long")


def insertion_point(time: Column, start: str, step_seconds: int) -> Column:
    """The first place of the axis that isn't before the time."""
    return F.ceil((F.unix_seconds(time) - F.unix_seconds(F.lit(start).cast("timestamp"))) / step_seconds)


def snap(ts: Column, step: int = 300, tolerance: int = 120) -> Column:
    """The nearest slot of step seconds; null when it is farther than tolerance."""
    micros = F.unix_micros(ts)
    slot = F.floor((micros + step * 500_000) / (step * 1_000_000)) * (step * 1_000_000)
    return F.when(F.abs(micros - slot) <= tolerance * 1_000_000, F.timestamp_micros(slot.cast("long")))


def snapped_frames(frames: DataFrame, step: int = 300, tolerance: int = 120, keys: tuple[str, ...] = ("cell_id",), ts: str = "ts") -> DataFrame:
    """frames with slot instead of ts; of the frames of one slot the nearest stays, of equally near ones the later."""
    slotted = frames.withColumn("slot", snap(F.col(ts), step, tolerance)).where("slot is not null")
    gap = F.abs(F.unix_micros(ts) - F.unix_micros("slot"))
    rest = [c for c in frames.columns if c not in keys and c != ts]
    best = F.min_by(F.struct(*rest), F.struct(gap, -F.unix_micros(ts), *rest))
    return slotted.groupBy("slot", *keys).agg(best.alias("_best")).select("slot", *keys, "_best.*")


def nearest_in_time(frames: DataFrame, slots: DataFrame, tolerance: int, step: int, keys: tuple[str, ...] = ("cell_id",), ts: str = "ts") -> DataFrame:
    """For each slot and key the frame nearest to it within tolerance seconds; of equally near ones the later.

    Frames meet slots by an equality of buckets: a frame can serve the slots of its own bucket and the next ones only.
    """
    reach = -(-tolerance // step)
    bucket = F.floor(F.unix_seconds(ts) / step)
    spread = frames.withColumn("_b", F.explode(F.sequence(bucket - reach, bucket + reach)))
    found = slots.withColumn("_b", F.floor(F.unix_seconds("slot") / step)).join(spread, "_b").drop("_b")
    gap = F.abs(F.unix_micros(ts) - F.unix_micros("slot"))
    rest = [c for c in frames.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(gap, -F.unix_micros(ts), *(c for c in rest if c != ts)))
    return found.where(gap <= tolerance * 1_000_000).groupBy("slot", *keys).agg(best.alias("_best")).select("slot", *keys, "_best.*")


def valid_time(cycles: DataFrame, init: str = "init_time", lead: str = "lead_hour", month: str | None = None, longest: int | None = None) -> DataFrame:
    """Forecast cycles by valid time (init + lead hours), those of one month (yyyy-MM) if asked.

    Leads aren't negative, so cycles after the month aren't read; with longest, the longest lead there is, neither are those
    that end before it.
    """
    valid = F.timestamp_seconds(F.unix_seconds(init) + F.col(lead) * 3600)
    if month is not None:
        start = F.lit(f"{month}-01 00:00:00").cast("timestamp")
        end = F.lit(f"{int(month[:4]) + (month[5:] == '12'):04d}-{int(month[5:]) % 12 + 1:02d}-01 00:00:00").cast("timestamp")
        cycles = cycles.where(F.col(init) < end)
        if longest is not None:
            cycles = cycles.where(F.col(init) >= start - F.expr(f"interval {longest} hours"))
        cycles = cycles.where((valid >= start) & (valid < end))
    return cycles.withColumn("time", valid).drop(init, lead)


def prefer_valid_time(df: DataFrame, valid: str = "valid_time") -> DataFrame:
    """Time from valid_time where that is there."""
    return df.withColumn("time", F.coalesce(valid, "time")).drop(valid) if valid in df.columns else df


def run_of(spine: DataFrame, lead_hours: int) -> DataFrame:
    """Valid times with the cycle that holds them at a lead (0 for analyses)."""
    return spine.withColumn("init_time", F.timestamp_seconds(F.unix_seconds("time") - lead_hours * 3600)).withColumn("lead_hour", F.lit(lead_hours))


def standard_calendar(noleap: DataFrame, spine: DataFrame, *keys: str) -> DataFrame:
    """Rows keyed by year, month, day, hour of a calendar without leap days on a standard axis; 29 February is missing."""
    at = noleap.withColumn("time", F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0))).drop("year", "month", "day", "hour")
    return reindex(at, spine, *keys)


def merge_first(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Outer merge; of a variable in both tables the left one's column stays whole."""
    return left.join(right.drop(*(c for c in right.columns if c in left.columns and c not in keys)), [*keys], "full")


def merge_common(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    return left.join(right, [*keys], "inner")


def merge_levels(levels: DataFrame, surface: DataFrame, group: str = "grp", *keys: str) -> DataFrame:
    """Model levels with surface variables; what the surface table holds on pressure levels is left out."""
    return merge_first(levels, surface.where(F.col(group) != "pl").drop(group), *(keys or ("time", "cell_id")))


def runs(df: DataFrame, index: str, *keys: str) -> DataFrame:
    """Contiguous runs of whole numbers: (keys, pos_start, pos_end, idx_start, idx_end), ends left out."""
    w = Window.partitionBy(*keys).orderBy(index)
    x = df.select(*keys, index).distinct().withColumn("_pos", F.row_number().over(w).cast("long") - 1)
    x = x.groupBy(*keys, (F.col(index) - F.col("_pos")).alias("_island"))
    out = x.agg(F.min("_pos").alias("pos_start"), (F.max("_pos") + 1).alias("pos_end"), F.min(index).alias("idx_start"), (F.max(index) + 1).alias("idx_end"))
    return out.drop("_island")


def blocks(df: DataFrame, size: int, order: str, *keys: str) -> DataFrame:
    """df with block: rows in order, size of them to a block."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("block", F.floor((F.row_number().over(w) - 1) / size))


def unwrap(grid: DataFrame, out: str = "lon_unwrapped") -> DataFrame:
    """Longitudes along x without jumps of more than half a turn; a jump of exactly half a turn stays as it is."""
    w = Window.partitionBy("y").orderBy("x")
    step = F.col("longitude") - F.lag("longitude").over(w)
    folded = F.pmod(step + 180.0, F.lit(360.0)) - 180.0
    folded = F.when((folded == -180.0) & (step > 0), F.lit(180.0)).otherwise(folded)
    fix = F.when(F.abs(step) < 180.0, F.lit(0.0)).otherwise(folded - step)
    marked = grid.withColumn("_fix", F.coalesce(fix, F.lit(0.0)))
    total = F.sum("_fix").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn(out, F.col("longitude") + total).drop("_fix")


def neighbours(grid: DataFrame) -> DataFrame:
    """grid with the coordinates of the next cell along x (lat_x, lon_x) and along y (lat_y, lon_y)."""
    along_x, along_y = Window.partitionBy("y").orderBy("x"), Window.partitionBy("x").orderBy("y")
    return grid.withColumns({
        "lat_x": F.lead("latitude").over(along_x), "lon_x": F.lead("longitude").over(along_x),
        "lat_y": F.lead("latitude").over(along_y), "lon_y": F.lead("longitude").over(along_y),
    })
