"""Unit names and conversions, and numeric time since an origin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Canonical names and units of variables.
VAR_META = [
    ("tp", "total precipitation", "kg m**-2"),
    ("sp", "surface pressure", "Pa"),
    ("si10", "10 m wind speed", "m s**-1"),
    ("u10", "10 m eastward wind", "m s**-1"),
    ("v10", "10 m northward wind", "m s**-1"),
    ("i10fg", "10 m wind gust", "m s**-1"),
    ("wdir10", "10 m wind direction", "Degree true"),
    ("t2m", "2 m air temperature", "K"),
    ("d2m", "2 m dew point temperature", "K"),
    ("sh2", "2 m specific humidity", "kg kg**-1"),
    ("rh2", "2 m relative humidity", "%"),
    ("orog", "surface geopotential height", "m"),
    ("fsr", "forecast surface roughness", "m"),
    ("u", "U component of wind", "m s**-1"),
    ("v", "V component of wind", "m s**-1"),
    ("t", "temperature", "K"),
    ("q", "specific humidity", "kg kg**-1"),
    ("z", "geopotential", "m**2 s**-2"),
]
# Fixed values: (variable, source units, target units, factor).
CONVERSIONS = [
    ("tp", "m", "kg m**-2", 1000.0),
    ("tp", "mm", "kg m**-2", 1.0),
    ("tp", "kg m-2", "kg m**-2", 1.0),
    ("tp", "kg m^-2", "kg m**-2", 1.0),
    ("tp", "kg m-2 s-1", "kg m**-2", 3600.0),
    ("sp", "hPa", "Pa", 100.0),
]
# Notation in lower case, canonical notation.
ALIASES = [
    ("m s-1", "m s**-1"),
    ("m s^-1", "m s**-1"),
    ("m/s", "m s**-1"),
    ("kg m-2", "kg m**-2"),
    ("kg m^-2", "kg m**-2"),
    ("kg kg-1", "kg kg**-1"),
    ("kg kg^-1", "kg kg**-1"),
    ("degree", "Degree true"),
    ("degrees", "Degree true"),
    ("degree true", "Degree true"),
    ("k", "K"),
    ("pa", "Pa"),
    ("hpa", "hPa"),
    ("1", "kg kg**-1"),
]


def literal_map(pairs: list[tuple[str, object]]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs for x in pair))


def normal_units(units: Column) -> Column:
    """Canonical notation of a unit; unknown ones, empty text and null pass through."""
    key = F.lower(F.regexp_replace(F.trim(units), r"\s+", " "))
    return F.when(units.isNull() | (units == ""), units).otherwise(F.coalesce(F.try_element_at(literal_map(ALIASES), key), units))


def target_units(var: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map([(v, u) for v, _, u in VAR_META]), var), F.lit(""))


def target_long_name(var: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map([(v, n) for v, n, _ in VAR_META]), var), var)


def conversion_factor(var: Column, units: Column) -> Column:
    """Factor to the variable's canonical units: 1 where notation differs only or either is empty; null where unknown."""
    table = literal_map([(f"{v}|{u}", f) for v, u, _, f in CONVERSIONS])
    target, normal = target_units(var), normal_units(units)
    same = units.isNull() | (units == "") | (target == "") | (normal == normal_units(target))
    found = F.coalesce(F.try_element_at(table, F.concat(var, F.lit("|"), units)), F.try_element_at(table, F.concat(var, F.lit("|"), normal)))
    return F.when(same, F.lit(1.0)).otherwise(found)


def source_units(units: Column, var: Column, fallback: dict[str, str], override: Column | None = None) -> Column:
    """Units of the source: an override, then its own, then the variable's fallback."""
    own = F.coalesce(F.when(F.trim(units) != "", units), F.try_element_at(literal_map([*fallback.items()]), var) if fallback else F.lit(None).cast("string"))
    return own if override is None else F.coalesce(F.when(F.trim(override) != "", override), own)


def convert(obs: DataFrame, units: str = "units", strict: bool = True) -> DataFrame:
    """obs (var, value, units) in canonical units, with long_name and units set. An unknown conversion is an error, or
    (not strict) a null value."""
    factor = strict_factor(F.col("var"), F.col(units)) if strict else conversion_factor(F.col("var"), F.col(units))
    return obs.withColumns({"value": F.col("value") * factor, "long_name": target_long_name(F.col("var"))}).withColumn(units, target_units(F.col("var")))


def strict_factor(var: Column, units: Column) -> Column:
    """The factor, or an error where none is known."""
    factor = conversion_factor(var, units)
    return F.when(factor.isNull(), F.raise_error(F.concat(F.lit("No factor to canonical units for "), var, F.lit(": "), units)).cast("double")).otherwise(factor)


def unconvertible(obs: DataFrame, units: str = "units") -> DataFrame:
    """Distinct (var, units) that convert() would refuse."""
    return obs.select("var", units).distinct().where(conversion_factor(F.col("var"), F.col(units)).isNull())


def stamped(df: DataFrame, source: dict[str, str] | None = None) -> DataFrame:
    """A wide table whose known variables' columns carry their canonical units, long name and missing value as metadata.

    source: units that columns are in; their values are converted, and an unknown conversion is an error. Metadata is JSON,
    which has no NaN, so the missing value is that word; missing values themselves are null.
    """
    known = {v: {"units": u, "long_name": n, "_FillValue": "NaN", "missing_value": "NaN"} for v, n, u in VAR_META}
    value = lambda c: F.col(c) * strict_factor(F.lit(c), F.lit(source[c])) if source and source.get(c) else F.col(c)
    return df.select(*(value(c).alias(c, metadata=known[c]) if c in known else F.col(c) for c in df.columns))


def meta_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VAR_META, "var string, long_name string, units string")


def decode_time(raw: Column, units: Column) -> Column:
    """Timestamps of whole numbers of nanoseconds, minutes or hours since an origin ("minutes since 2018-01-01").

    Without units: nanoseconds since 1970. Unknown units are an error.
    """
    unit = F.lower(F.regexp_extract(units, r"^(\w+)\s+since\s+(.+)$", 1))
    origin = F.unix_micros(F.try_to_timestamp(F.regexp_extract(units, r"^(\w+)\s+since\s+(.+)$", 2)))
    micros = (
        F.when(units.isNull() | (unit == ""), F.floor(raw / 1000))
        .when(unit.isin("nanosecond", "nanoseconds"), F.floor(raw / 1000))
        .when(unit.isin("minute", "minutes"), origin + raw * 60_000_000)
        .when(unit.isin("hour", "hours"), origin + raw * 3_600_000_000)
        .otherwise(F.raise_error(F.concat(F.lit("Unsupported time unit: "), units)).cast("long"))
    )
    return F.timestamp_micros(micros)


def encode_time(time: Column, unit: str, origin: str) -> Column:
    size = {"nanoseconds": 1e-3, "minutes": 60_000_000, "hours": 3_600_000_000}[unit]
    micros = F.unix_micros(time)
    return (micros * 1000) if unit == "nanoseconds" else ((micros - F.unix_micros(F.to_timestamp(F.lit(origin)))) / F.lit(size)).cast("long")
