"""Tables written to the shared folder of the cluster, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset: a new temporary folder on one machine, an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _own.setdefault(id(spark), "file://" + tempfile.mkdtemp(prefix="spark-"))
    return folder


_own: dict[int, str] = {}


def staged(df: DataFrame, tag: str, compression: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: later stages survive lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores in front as make them differ from all columns, whatever their case."""
    taken = {c.lower() for c in df.columns}
    mark = ""
    while any(mark + n in taken for n in names):
        mark += "_"
    return [mark + n for n in names]
