"""Selection: names, boxes, index rectangles, masks, time ranges, levels."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.weather import longitude_360


def rename(df: DataFrame, names: dict[str, str], var: str | None = None) -> DataFrame:
    """Rename columns that are there, or with var the values of that column."""
    if var is None:
        return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})
    return df.withColumn(var, F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in names.items() for x in p)), F.col(var)), F.col(var)))


def only(df: DataFrame, *names: str) -> DataFrame:
    """Those of the columns that are there, in the asked order."""
    return df.select(*(c for c in names if c in df.columns))


def as_float(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("float") for c in names})


def box_bounds(grid: DataFrame, west: float, east: float) -> DataFrame:
    """One row (_west, _east): negative bounds get 360 added when the grid counts longitudes beyond 180."""
    wide = F.max("longitude") > 180
    shift = lambda b: F.when(wide & (F.lit(b) < 0), F.lit(b + 360.0)).otherwise(F.lit(float(b)))
    return grid.agg(shift(west).alias("_west"), shift(east).alias("_east"))


def crop_box(df: DataFrame, south: float, north: float, west: float, east: float, grid: DataFrame | None = None) -> DataFrame:
    """Rows with latitude and longitude in the box, both ends included. grid: where to see how longitudes count."""
    bounds = box_bounds(df if grid is None else grid, west, east).first()  # one row of a grid; literals reach the scan
    return df.where(F.col("latitude").between(south, north) & F.col("longitude").between(bounds["_west"], bounds["_east"]))


def crop_rectangle(grid: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    """Cells of the index rectangle that bounds the box: corners outside of the box stay. No cell inside is an error."""
    inside = crop_box(grid, south, north, west, east)
    frame = inside.agg(F.min("y").alias("_y0"), F.max("y").alias("_y1"), F.min("x").alias("_x0"), F.max("x").alias("_x1"))
    frame = frame.withColumn("_y0", F.when(F.col("_y0").isNull(), F.raise_error(F.lit("No grid cell lies in the box")).cast("int")).otherwise(F.col("_y0")))
    return grid.join(F.broadcast(frame), F.col("y").between(F.col("_y0"), F.col("_y1")) & F.col("x").between(F.col("_x0"), F.col("_x1"))).drop("_y0", "_y1", "_x0", "_x1")


def crop_index(df: DataFrame, y0: int, y1: int, x0: int, x1: int) -> DataFrame:
    """Cells y0 <= y < y1 and x0 <= x < x1."""
    return df.where((F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1))


def crop_mask(obs: DataFrame, mask: DataFrame) -> DataFrame:
    """Observations of the mesh nodes whose mask is true."""
    return obs.join(mask.where("mask").select("cell_id"), "cell_id", "left_semi")


def crop_halo(grid: DataFrame, other: DataFrame, halo: float) -> DataFrame:
    """Cells of the index rectangle around the other grid's box, widened by halo degrees; longitudes are compared in [0, 360)."""
    lon = longitude_360(F.col("longitude"))
    box = other.agg(F.min("latitude").alias("_s"), F.max("latitude").alias("_n"), F.min(lon).alias("_w"), F.max(lon).alias("_e"))
    inside = grid.join(F.broadcast(box), F.col("latitude").between(F.col("_s") - halo, F.col("_n") + halo) & lon.between(F.col("_w") - halo, F.col("_e") + halo))
    frame = inside.agg(F.min("y").alias("_y0"), F.max("y").alias("_y1"), F.min("x").alias("_x0"), F.max("x").alias("_x1"))
    return grid.join(F.broadcast(frame), F.col("y").between(F.col("_y0"), F.col("_y1")) & F.col("x").between(F.col("_x0"), F.col("_x1"))).drop("_y0", "_y1", "_x0", "_x1")


def with_coordinates(obs: DataFrame, grid: DataFrame) -> DataFrame:
    """Observations with their cells' coordinates."""
    return obs.join(grid, "cell_id")


def partial_end(text: str) -> tuple[str, bool]:
    """(first moment after a year, month, day or timestamp, whether to leave it out)."""
    text = text.strip()
    if m := re.fullmatch(r"(\d{4})", text):
        return f"{int(m[1]) + 1:04d}-01-01 00:00:00", True
    if m := re.fullmatch(r"(\d{4})-(\d{2})", text):
        y, k = divmod(int(m[1]) * 12 + int(m[2]), 12)
        return f"{y:04d}-{k + 1:02d}-01 00:00:00", True
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        return f"{dt.date.fromisoformat(text) + dt.timedelta(1)} 00:00:00", True
    return text.replace("T", " "), False


def partial_start(text: str) -> str:
    text = text.strip().replace("T", " ")
    return text + "-01-01 00:00:00"[3 * (len(text) - 4) // 3 :] if len(text) in (4, 7) else text


def time_range(df: DataFrame, start: str, end: str, time: str = "time") -> DataFrame:
    """Rows from start to end; a year, month or day as an end includes all of it."""
    last, without = partial_end(end)
    upper = F.col(time) < F.lit(last).cast("timestamp") if without else F.col(time) <= F.lit(last).cast("timestamp")
    return df.where((F.col(time) >= F.lit(partial_start(start)).cast("timestamp")) & upper)


def month_of(df: DataFrame, month: str, time: str = "time") -> DataFrame:
    return time_range(df, month, month, time)


def process_bounds(start: str, end: str) -> tuple[dt.datetime, dt.datetime]:
    """Start and end of a job; an end that is a date means its last hour. An end before the start is an error."""
    a = dt.datetime.fromisoformat(start)
    b = dt.datetime.fromisoformat(end)
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", end.strip()):
        b += dt.timedelta(hours=23)
    if b < a:
        raise ValueError(f"End {b} is before start {a}")
    return a, b


def clip_period(start: Column, end: Column, first: Column, last: Column) -> tuple[Column, Column]:
    return F.greatest(start, first), F.least(end, last)


def select_levels(df: DataFrame, levels: list[float], strict: bool = True, level: str = "level") -> DataFrame:
    """Rows of the levels, matched within a tolerance. With strict, a level that no row has is an error."""
    have = [r[0] for r in df.select(level).distinct().where(F.col(level).isNotNull()).collect()]  # a product's levels are few
    close = lambda h, x: abs(float(h) - x) <= 1e-8 + 1e-5 * abs(x)
    if strict and (missing := [x for x in levels if not any(close(h, x) for h in have)]):
        raise ValueError(f"Levels not found: {missing}")
    return df.where(F.col(level).isin([h for h in have if any(close(h, x) for x in levels)]))  # literals reach the scan


def infer_group(dims: Column) -> Column:
    """sl, pl or ml by the dimensions' names."""
    has = lambda *names: F.arrays_overlap(dims, F.array(*map(F.lit, names)))
    return F.when(has("model_level", "hybrid"), "ml").when(has("level", "isobaricInhPa", "pressure_level"), "pl").otherwise("sl")


def squeeze(df: DataFrame, *names: str) -> DataFrame:
    """Without key columns that hold one value; a second value is an error."""
    counts = df.agg(*(F.count_distinct(c).alias(c) for c in names)).first()
    if wrong := [c for c in names if counts[c] > 1]:
        raise ValueError(f"Not constant: {wrong}")
    return df.drop(*names)


def fill_missing(df: DataFrame, value: float, *names: str) -> DataFrame:
    return df.na.fill(value, subset=[*names] or None)


def stride(grid: DataFrame, sy: int, sx: int) -> DataFrame:
    return grid.where((F.col("y") % sy == 0) & (F.col("x") % sx == 0))


def expand_dependencies(wanted: list[str], deps: dict[str, list[str]], keep: bool = True) -> list[str]:
    """Variables to read for those wanted, each once in order; derived names stay after their parts, or go (not keep)."""
    out: list[str] = []
    for v in wanted:
        for x in [*deps.get(v, []), *([v] if keep or v not in deps else [])]:
            if x not in out:
                out.append(x)
    return out


def with_dependencies(wanted: Column, deps: dict[str, list[str]], keep: bool = True) -> Column:
    """The same for a column of lists of variables."""
    parts = F.create_map(*(F.lit(x) for x in (y for v, p in deps.items() for y in (v, ",".join(p))))) if deps else None
    of = lambda v: F.split(F.try_element_at(parts, v), ",") if deps else F.lit(None).cast("array<string>")
    own = lambda v: F.array(v) if keep else F.when(of(v).isNull(), F.array(v)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.transform(wanted, lambda v: F.concat(F.coalesce(of(v), F.array().cast("array<string>")), own(v)))))


def all_parts(deps: DataFrame) -> DataFrame:
    """(var, part, level) of a dependency table (var, part): what each variable needs, directly or through others; level is
    how many steps lie between the part and variables that need nothing, so parts of lesser level come first.

    A variable that needs itself is an error. The table is a catalogue of variables, which is followed by a recursive query
    for as many steps as it has variables.
    """
    spark = deps.sparkSession
    deps = deps.select("var", "part").distinct()
    n = deps.select("var").distinct().count()
    x = spark.sql(
        """WITH RECURSIVE r(var, part, steps) AS (
        SELECT var, part, 1 FROM {deps} UNION ALL SELECT r.var, d.part, r.steps + 1 FROM r JOIN {deps} d ON d.var = r.part WHERE r.steps <= {n} AND r.var <> r.part)
        SELECT var, part, max(steps) AS steps FROM r GROUP BY var, part""", deps=deps, n=n)  # fmt: skip
    if (loop := x.where("var = part").agg(F.min("var")).first()[0]) is not None:
        raise ValueError(f"{loop} needs itself")
    level = x.groupBy("var").agg(F.max("steps").alias("level"))
    return x.join(level.withColumnRenamed("var", "part"), "part", "left").select("var", "part", F.coalesce("level", F.lit(0)).alias("level"))


def needed(wanted: DataFrame, deps: DataFrame, *keys: str) -> DataFrame:
    """(keys, var, level): the variables wanted (keys, var) and all that they need, each once for a key."""
    parts = all_parts(deps)
    own = parts.groupBy("var").agg((F.max("level") + 1).alias("level"))
    asked = wanted.select(*keys, "var").join(own, "var", "left").select(*keys, "var", F.coalesce("level", F.lit(0)).alias("level"))
    more = wanted.select(*keys, "var").join(parts, "var").select(*keys, F.col("part").alias("var"), "level")
    return asked.unionByName(more).distinct()


def needed_in_order(wanted: DataFrame, deps: DataFrame, *keys: str) -> DataFrame:
    """(keys, need): the array of the variables wanted and all that they need, parts first, one row a key.

    What each different variable needs is told once, as bits of numbers of 63 variables each, so a key is a few numbers in
    a task and not a row or a list of its variables. The different variables come to the driver.
    """
    of = [*needed(wanted.select(F.col("var").alias("_asked"), "var").distinct(), deps, "_asked").collect()]  # bounded by the catalogue
    place = {v: i for i, (_, v) in enumerate(sorted({(r["level"], r["var"]) for r in of}))}
    words = range(len(place) // 63 + 1)
    bits: dict[str, list[int]] = {}
    for r in of:
        bits.setdefault(r["_asked"], [0 for _ in words])[place[r["var"]] // 63] |= 1 << place[r["var"]] % 63
    told = wanted.sparkSession.createDataFrame([(v, *b) for v, b in bits.items()], ", ".join(["var string", *(f"_w{k} long" for k in words)]))
    x = wanted.join(F.broadcast(told), "var").groupBy(*keys).agg(*(F.bit_or(f"_w{k}").alias(f"_w{k}") for k in words))
    some = (F.when(F.getbit(f"_w{i // 63}", F.lit(i % 63)) == 1, v) for v, i in place.items())
    return x.select(*keys, F.array_compact(F.array(F.lit(None).cast("string"), *some)).alias("need"))


def period_bounds(start: Column, end: Column) -> tuple[Column, Column]:
    """process_bounds for columns of texts; an end before the start is an error when the rows are read."""
    a, b = start.cast("timestamp"), end.cast("timestamp")
    b = F.when(F.trim(end).rlike(r"^\d{4}-\d{2}-\d{2}$"), b + F.expr("interval 23 hours")).otherwise(b)
    return a, F.when(b < a, F.raise_error(F.format_string("End %s is before start %s", end, start)).cast("timestamp")).otherwise(b)


def single_types(types: DataFrame, kind: str, *keys: str) -> DataFrame:
    """(keys, kind): the one kind of each key's rows; a key with several is an error when the rows are read."""
    n = types.groupBy(*keys).agg(F.min(kind).alias("_a"), F.max(kind).alias("_b"))
    wrong = F.raise_error(F.format_string("Several kinds: %s, %s", "_a", "_b")).cast("string")
    return n.select(*keys, F.when(F.col("_a").eqNullSafe(F.col("_b")), F.col("_a").cast("string")).otherwise(wrong).alias(kind))


def single_type(types: dict[str, str], names: list[str]) -> str:
    """The one source type of the variables; several are an error."""
    found = sorted({types[n] for n in names})
    if len(found) != 1:
        raise ValueError(f"Variables of several source types: {found}")
    return found[0]


def preprocess_each(parts: list[DataFrame], step: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One table of many, each put through step below the union."""
    out = None
    for part in parts:
        part = part.transform(step) if step else part
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("No tables to concatenate")
    return out
