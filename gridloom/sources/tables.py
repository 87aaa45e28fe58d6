"""Registries, catalogues and listings read from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG = "index int, source_id string, experiment_id string, variant string, realization string, ncml_timerange string, sim_start_year int, sim_end_year int, dest_subdir string"


def registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """A registry with a header; all columns text."""
    return spark.read.csv(path, header=True, multiLine=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=CATALOG, mode="FAILFAST")


def description_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(var, description, long_name, units) of blocks separated by blank lines: 'Variable: X' and 'key: value' lines."""
    blocks = spark.read.text(path, lineSep="\n\n").where(F.trim("value") != "")
    return blocks.select(*described(F.col("value")))


def described(block: Column) -> list[Column]:
    get = lambda key: F.trim(F.regexp_extract(block, rf"(?m)^\s*{key}:[ \t]*(.*)$", 1))
    return [get("Variable").alias("var"), get("description").alias("description"), get("long_name").alias("long_name"), get("units").alias("units")]


def description_text(df: DataFrame) -> DataFrame:
    """The same blocks as one text column."""
    line = lambda key: F.concat(F.lit(f"  {key}: "), F.coalesce(key, F.lit("")))
    return df.select(F.concat_ws("\n", F.concat(F.lit("Variable: "), "var"), line("description"), line("long_name"), line("units"), F.lit("")).alias("value"))


def message_list(spark: SparkSession, path: str) -> DataFrame:
    """(short_name, name, level, type_of_level) of a listing in columns separated by white space; names hold spaces."""
    x = spark.read.text(path).where(F.col("value").rlike(r"^\S+\s+.+\s+-?\d+\s+\S+\s*$"))
    part = lambda k: F.regexp_extract("value", r"^(\S+)\s+(.+?)\s+(-?\d+)\s+(\S+)\s*$", k)
    return x.select(part(1).alias("short_name"), part(2).alias("name"), part(3).cast("int").alias("level"), part(4).alias("type_of_level"))


def column_of(df: DataFrame, *names: str) -> str:
    """The first of the names that is a column, or one whose standard_name is the first name; else an error."""
    for n in names:
        if n in df.columns:
            return n
    for f in df.schema.fields:
        if f.metadata.get("standard_name") == names[0]:
            return f.name
    raise ValueError(f"None of {names} in {df.columns}")


def target_grid(df: DataFrame) -> DataFrame:
    """A grid with latitude and longitude, whatever they are called; it must have y and x."""
    lat, lon = column_of(df, "latitude", "lat"), column_of(df, "longitude", "lon")
    if not {"y", "x"} <= {*df.columns}:
        raise ValueError("The grid has no y and x")
    return df.withColumnsRenamed({lat: "latitude", lon: "longitude"})
