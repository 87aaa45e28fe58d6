"""Listings of real folders as tables, without reading what the files hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def listed(spark: SparkSession, folder: str, *below: str, names: str | None = None) -> DataFrame:
    """(path, size, modified) of the files under a folder, at any depth.

    below: patterns of paths under the folder, such as day=2024-02-*, so that no other folder is listed (none there: an
    error). names: a pattern of file names. Contents are no column of the scan, so no file is opened. Files without any byte
    aren't listed, so that checks of what is there count them as missing.
    """
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if names is not None:
        x = x.option("pathGlobFilter", names)
    x = x.load([f"{folder}/{b}" for b in below] or folder)
    return x.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def date_of_path(path: Column) -> Column:
    """The first date in a path, as 2024-02-09 or 20240209; null without one."""
    digits = F.regexp_replace(F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2}|\d{8})", 1), "-", "")
    return F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMdd")).cast("date")
