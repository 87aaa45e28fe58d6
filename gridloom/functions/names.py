"""Column expressions for registry texts, paths, variable lists and attribute lookups."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Level names that documentation writes otherwise.
LEVEL_ALIASES = {"0.1_sigma_layer": "0.1_sigma_level"}
METADATA_PREFIX = ".z"
TRUE_WORDS = ("1", "true", "yes", "y")


def clean_text(text: Column) -> Column:
    """No-break spaces as spaces, runs of white space as one, none at the ends; null as empty."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), " ", " "), r"\s+", " "))


def normal_level(text: Column) -> Column:
    clean = clean_text(text)
    for alias, name in LEVEL_ALIASES.items():
        clean = F.when(clean == alias, name).otherwise(clean)
    return F.replace(F.replace(clean, F.lit("_Above_"), F.lit("_above_")), F.lit("_Ground"), F.lit("_ground"))


def modes(text: Column) -> Column:
    """Array of run types: both gives anl and fcst; anything else than these is an error."""
    m = F.lower(clean_text(text))
    wrong = F.raise_error(F.concat(F.lit("Neither anl, fcst nor both: "), m)).cast("array<string>")
    return F.when(m == "both", F.array(F.lit("anl"), F.lit("fcst"))).when(m.isin("anl", "fcst"), F.array(m)).otherwise(wrong)


def first_attr(attrs: Column, *keys: str) -> Column:
    """The first of the JSON attributes that isn't blank, trimmed; null without one."""
    return F.coalesce(*(F.nullif(F.trim(F.get_json_object(attrs, f"$.{k}")), F.lit("")) for k in keys))


def first_known(known: Column, *keys: str) -> Column:
    """The same from a map of attributes, read once for any number of lookups."""
    return F.coalesce(*(F.nullif(F.trim(known[k]), F.lit("")) for k in keys))


TARGET = ("GRIB_cfVarName", "cfVarName", "cf_var_name", "short_name", "GRIB_shortName")


def target_var(attrs: Column, source_var: Column) -> Column:
    return F.coalesce(first_attr(attrs, *TARGET), source_var)


def dimensions(rank: Column, run_type: Column, attrs: Column | None = None, known: Column | None = None) -> Column:
    """Names of an array's dimensions: those that its attributes (JSON or a map) state, else by its rank and run type."""
    numbered = F.transform(F.sequence(F.lit(0), rank - 1), lambda i: F.concat(F.lit("dim_"), i.cast("string")))
    text = known["_ARRAY_DIMENSIONS"] if known is not None else None if attrs is None else F.get_json_object(attrs, "$._ARRAY_DIMENSIONS")
    stated = F.lit(None).cast("array<string>") if text is None else F.from_json(text, "array<string>")
    return (
        F.when(F.size(stated) > 0, stated)
        .when((run_type == "anl") & (rank == 2), F.array(F.lit("y"), F.lit("x")))
        .when((run_type == "fcst") & (rank == 3), F.array(F.lit("forecast_step"), F.lit("y"), F.lit("x")))
        .when(rank > 0, numbered)
        .otherwise(F.array().cast("array<string>"))
    )


def offered(target: Column, source: Column, long_name: Column) -> Column:
    """0 for orography and geopotential heights, else 1."""
    text = F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in (target, source, long_name))))
    return F.when(text.contains("orog") | text.contains("geopotential height"), 0).otherwise(1)


def truthy(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin(*TRUE_WORDS), F.lit(False))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def is_metadata(path: Column) -> Column:
    return F.startswith(base_name(path), F.lit(METADATA_PREFIX))


def list_items(text: Column) -> Column:
    """Items of a list separated by commas or spaces, blank ones left out, each once, in order."""
    return F.array_distinct(F.filter(F.split(F.trim(text), r"[,\s]+"), lambda x: x != ""))


def hour_of_name(path: Column) -> Column:
    """Hour in names like t06z or .2019010106.pcp_01h; 0 without one."""
    a, b = F.regexp_extract(path, r"t(\d{2})z", 1), F.regexp_extract(path, r"\.\d{8}(\d{2})\.", 1)
    return F.when(a != "", a.cast("int")).when(b != "", b.cast("int")).otherwise(0)


def time_of_name(path: Column) -> Column:
    """Timestamp in names like 20190101-063000; null without one."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(path, r"(\d{8}-\d{6})", 1), F.lit("")), F.lit("yyyyMMdd-HHmmss"))


def archive_path(family: Column, time: Column, run_type: Column) -> Column:
    day = F.date_format(time, "yyyyMMdd")
    return F.concat(F.lit("archive/"), family, F.lit("/"), day, F.lit("/"), day, F.lit("_"), F.date_format(time, "HH"), F.lit("z_"), run_type, F.lit(".zarr"))


def index_list(spec: str, largest: int) -> list[int]:
    """'0-5,10' as sorted numbers; any beyond 0..largest is an error."""
    out: set[int] = set()
    for part in (p.strip() for p in spec.split(",")):
        m = re.fullmatch(r"(\d+)(?:\s*-\s*(\d+))?", part)
        if not m:
            raise ValueError(f"Not an index or range: {part!r}")
        out |= set(range(int(m[1]), int(m[2] or m[1]) + 1))
    if wrong := sorted(i for i in out if not 0 <= i <= largest):
        raise ValueError(f"The catalogue ends at {largest}: no rows {wrong}")
    return sorted(out)


def index_spec_items(spec: Column) -> Column:
    """The same as a column: an array of sorted numbers."""

    def numbers(part: Column) -> Column:
        ends = F.transform(F.split(part, "-"), lambda x: F.trim(x).cast("int"))
        return F.sequence(F.element_at(ends, 1), F.element_at(ends, -1))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(spec, ","), numbers))))
