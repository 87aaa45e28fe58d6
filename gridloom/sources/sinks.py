"""Written results: audits and statistics, registries, variable descriptions; and scratch folders for them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.registry import sorted_registry
from .tables import description_text


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder (spark.checkpoint.dir). Where that is unset: on this machine, or an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{folder}/{tag}-{uuid.uuid4().hex}"


def write_result(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Audit or statistics rows as parquet, csv (with a header) or json."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if kind == "csv" else writer).format(kind).save(path)


def write_registry(df: DataFrame, path: str, *keys: str) -> None:
    """A registry as CSV with a header, in the order of family, run type, level and source variable, or of other keys."""
    sorted_registry(df, *keys).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def numbered(df: DataFrame, *keys: str) -> DataFrame:
    """df with place, each row's number in the order of the keys, nulls last, from 1.

    Rows are sorted by range and written with their partition and place in it; the partitions' sizes, one row each, give
    what lies before a partition. So no task holds more than its range.
    """
    at = F.monotonically_increasing_id()  # partition << 33, and the row's number in it
    path = scratch(df.sparkSession, "sorted")
    sorted_registry(df, *keys).withColumn("_at", at).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumns({"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND((1 << 33) - 1)})
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", before.alias("_before"))  # a row for each partition
    return rows.join(sizes, "_part").withColumn("place", F.col("_before") + F.col("_row") + 1).select(*df.columns, "place")


def write_descriptions(df: DataFrame, path: str) -> None:
    """Variables (var, description, long_name, units) as blocks of text, an empty line between them."""
    description_text(df).write.mode("overwrite").text(path)
