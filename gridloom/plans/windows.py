"""Plans of work: time windows, download tasks, tiles, file choices. Nothing is fetched."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_windows(requests: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """requests with win_start, win_end and label: the months of start to end (timestamps), cut to them, last hours whole."""
    month = F.explode(F.expr(f"sequence(trunc({start}, 'MM'), trunc({end}, 'MM'), interval 1 month)"))
    x = requests.withColumn("_m", month)
    last = F.timestamp_seconds(F.unix_seconds(F.last_day("_m").cast("timestamp")) + 23 * 3600)
    x = x.withColumns({"win_start": F.greatest(F.col("_m").cast("timestamp"), F.col(start)), "win_end": F.least(last, F.col(end)), "label": F.date_format("_m", "yyyy-MM")})
    return x.where("win_start <= win_end").drop("_m")


def time_windows(catalog: DataFrame, mode: str, start_year: str = "sim_start_year", end_year: str = "sim_end_year", timerange: str = "ncml_timerange") -> DataFrame:
    """catalog with win_start, win_end (ISO texts) and label, by mode: static, full, year or month."""
    first, last = F.make_date(start_year, F.lit(1), F.lit(1)), F.make_date(end_year, F.lit(12), F.lit(31))
    iso = lambda d, hour: F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(f"T{hour:02d}:00:00Z"))
    if mode == "static":
        anchor = F.to_date(F.substring(timerange, 1, 8), "yyyyMMdd")
        return catalog.withColumns({"win_start": iso(anchor, 0), "win_end": iso(anchor, 1), "label": F.lit("static")})
    if mode == "full":
        return catalog.withColumns({"win_start": iso(first, 0), "win_end": iso(last, 23), "label": F.concat_ws("-", start_year, end_year)})
    if mode == "year":
        x = catalog.withColumn("_y", F.explode(F.sequence(start_year, end_year)))
        return x.withColumns({"win_start": iso(F.make_date("_y", F.lit(1), F.lit(1)), 0), "win_end": iso(F.make_date("_y", F.lit(12), F.lit(31)), 23), "label": F.col("_y").cast("string")}).drop("_y")
    if mode == "month":
        x = catalog.withColumn("_m", F.explode(F.sequence(first, last, F.expr("interval 1 month"))))
        return x.withColumns({"win_start": iso(F.col("_m"), 0), "win_end": iso(F.last_day("_m"), 23), "label": F.date_format("_m", "yyyy-MM")}).drop("_m")
    raise ValueError(f"Unknown window mode: {mode!r}")


def day_windows(requests: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """requests with day, day_start and day_end (23:00)."""
    x = requests.withColumn("day", F.explode(F.expr(f"sequence(to_date({start}), to_date({end}), interval 1 day)")))
    return x.withColumns({"day_start": F.col("day").cast("timestamp"), "day_end": F.timestamp_seconds(F.unix_seconds(F.col("day").cast("timestamp")) + 23 * 3600)})


def next_month(yyyymm: Column) -> Column:
    return F.date_format(F.add_months(F.to_date(F.concat(yyyymm.cast("string"), F.lit("01")), "yyyyMMdd"), 1), "yyyyMM").cast("int")


def days_in_month(date: Column) -> Column:
    return F.dayofmonth(F.last_day(date))


def download_plan(catalog: DataFrame, mode: str, variables: list[str], base: str) -> DataFrame:
    """(index, label, url, path) of each simulation and window."""
    x = time_windows(catalog, mode)
    name = F.format_string("%s_%s_%s_%s_%s", "source_id", "experiment_id", "variant", "realization", "ncml_timerange")
    query = F.concat(F.lit("&".join(f"var={v}" for v in variables) + "&time_start="), F.url_encode("win_start"), F.lit("&time_end="), F.url_encode("win_end"))
    return x.select("index", "label", F.concat(F.lit(base + "/"), name, F.lit(".ncml?"), query).alias("url"), F.concat_ws("/", "dest_subdir", F.concat(name, F.lit("_"), "label", F.lit(".nc"))).alias("path"))


def not_there(plan: DataFrame, manifest: DataFrame) -> DataFrame:
    """Tasks whose path no file has."""
    return plan.join(manifest.select("path"), "path", "left_anti")


def not_verified(plan: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """Tasks (path, remote_size) whose file is absent or of another size."""
    have = manifest.groupBy(key).agg(F.max("size").alias("local_size"))
    x = plan.join(have, key, "left")
    return x.where(F.col("local_size").isNull() | ~F.col("local_size").eqNullSafe(F.col("remote_size")))


def layout_prefix(date: Column, hour: Column) -> Column:
    """Folder of a forecast cycle: from 2021-03-23 on with an atmos level (a fixed date of the archive)."""
    folder = F.concat(F.lit("run."), F.date_format(date, "yyyyMMdd"), F.lit("/"), F.lpad(hour.cast("string"), 2, "0"), F.lit("/"))
    return F.when(date < F.lit("2021-03-23").cast("date"), folder).otherwise(F.concat(folder, F.lit("atmos/")))


def first_file(manifest: DataFrame, *keys: str) -> DataFrame:
    """The first path of each key."""
    w = Window.partitionBy(*keys).orderBy("path")
    return manifest.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def template_file(manifest: DataFrame, pattern: str) -> str:
    """The first path that matches; none is an error."""
    found = manifest.where(F.col("path").rlike(pattern)).agg(F.min("path")).first()[0]
    if found is None:
        raise ValueError(f"No file matches {pattern!r}")
    return found


def chosen_files(manifest: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Files by (include | exclude, regular expression) rules; the last rule that matches holds, without one the file stays."""
    keep = F.lit(True)
    for kind, pattern in rules:
        keep = F.when(F.col("path").rlike(pattern), F.lit(kind == "include")).otherwise(keep)
    return manifest.where(keep)


def tiles(boxes: DataFrame, step: int = 30) -> DataFrame:
    """(box columns, tile) for boxes (west, south, east, north): names of the step x step degree tiles that cover them."""
    snap = lambda c: F.floor(F.col(c) / step) * step
    x = boxes.withColumn("_lat", F.explode(F.sequence(snap("south"), snap("north"), F.lit(step).cast("long")))).withColumn("_lon", F.explode(F.sequence(snap("west"), snap("east"), F.lit(step).cast("long"))))
    part = lambda c, low, high, n: F.concat(F.when(F.col(c) < 0, low).otherwise(high), F.lpad(F.abs(c).cast("string"), n, "0"))
    return x.withColumn("tile", F.concat(part("_lat", "s", "n", 2), part("_lon", "w", "e", 3))).drop("_lat", "_lon")


def day_files(manifest: DataFrame, day: str) -> DataFrame:
    """Files of a day by the hour in their names."""
    from ..functions.names import time_of_name

    first = dt.date.fromisoformat(day)
    if "date" in manifest.columns:  # reaches the scan
        manifest = manifest.where(F.col("date") == F.lit(first))
    x = manifest.withColumn("time", time_of_name(F.col("path")))
    x = x.where((F.col("time") >= F.lit(first)) & (F.col("time") < F.lit(first + dt.timedelta(1))))
    return x.orderBy(F.hour("time"), "path")


def month_files(manifest: DataFrame, kinds: list[str], codes: list[str], month: str) -> DataFrame:
    """Files of kinds and codes (columns) of a month (yyyy-MM)."""
    first = dt.date.fromisoformat(f"{month}-01")
    after = (first + dt.timedelta(31)).replace(day=1)
    return manifest.where(F.col("kind").isin(kinds) & F.col("code").isin(codes) & (F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(after)))
