"""Frames in one file a variable and time, read with what went wrong instead of failing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "var string, time timestamp, cell_id long, value float, error string"
ARROW = pa.schema([("var", pa.string()), ("time", pa.timestamp("us", "UTC")), ("cell_id", pa.int64()), ("value", pa.float32()), ("error", pa.string())])
UTC = dt.UTC


@dataclass
class Block(InputPartition):
    """Times first, first + step, ... of one variable."""

    var: str
    first: dt.datetime
    n: int


class FrameReader(DataSourceReader):
    """Blocks of a variable's times; filters on var and time leave out blocks and files before any is opened."""

    def __init__(self, options: dict):
        self.root, self.template = options["path"].rstrip("/"), options["template"]
        self.variables = options["variables"].split(",")
        self.start, self.end = (dt.datetime.fromisoformat(options[k]).replace(tzinfo=UTC) for k in ("start", "end"))
        self.step, self.block = dt.timedelta(seconds=int(options["step"])), int(options["block"])

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("var",) and isinstance(f, EqualTo | In):
                names = f.value if isinstance(f, In) else [f.value]
                self.variables = [v for v in self.variables if v in names]
            elif column == ("time",) and isinstance(f, GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                self._narrow(f)
                yield f  # Spark looks again, at no cost to speak of
            else:
                yield f

    def _narrow(self, f: Filter) -> None:
        t = f.value if f.value.tzinfo else f.value.astimezone(UTC)
        if isinstance(f, GreaterThan | GreaterThanOrEqual):
            self.start += max(0, -(-(t - self.start) // self.step)) * self.step
        else:
            self.end = min(self.end, t)

    def partitions(self) -> list[Block]:
        n = max(0, (self.end - self.start) // self.step + 1)
        return [Block(v, self.start + k * self.step, min(self.block, n - k)) for v in self.variables for k in range(0, n, self.block)]

    def read(self, part: Block | None) -> Iterator[pa.RecordBatch]:
        for k in range(part.n if part else 0):  # without any block, Spark asks once for None
            yield from self._frame(part.var, part.first + k * self.step)

    def _frame(self, var: str, time: dt.datetime) -> list[pa.RecordBatch]:
        """A file's rows, or one row that says why there are none; never a part of a file."""
        try:
            files, path = fs.FileSystem.from_uri(f"{self.root}/{time.strftime(self.template.replace('{var}', var))}")
            x = pq.read_table(path, columns=["cell_id", "value"], filesystem=files, partitioning=None)
            columns = [pa.array([var] * len(x)), pa.array([time] * len(x), ARROW.field("time").type), pc.cast(x["cell_id"], pa.int64()), pc.cast(x["value"], pa.float32(), safe=False), pa.nulls(len(x), pa.string())]
            return pa.table(columns, schema=ARROW).to_batches(max_chunksize=65536)
        except (OSError, KeyError, ValueError) as e:  # Arrow's errors are kinds of these
            reason = "missing" if isinstance(e, FileNotFoundError) else f"{type(e).__name__}: {e}".splitlines()[0]
            return [pa.record_batch([[var], pa.array([time], ARROW.field("time").type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float32()), [reason]], schema=ARROW)]


class FrameFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frame_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FrameReader:
        return FrameReader(dict(self.options))


def read_frames(spark: SparkSession, folder: str, variables: list[str], start: str, end: str, step: int = 3600, template: str = "{var}/%Y%m%d/%H%M.parquet", block: int = 24) -> DataFrame:
    """(var, time, cell_id, value, error) of Parquet files (cell_id, value), one a variable and UTC time of the axis.

    A file that is missing, cut off, of other columns or of values that are no numbers gives one row of nulls with the
    reason in error; all other files are read. A file without rows gives no row. block times of a variable are a task;
    filters on var and time are pushed, so that other files aren't opened. folder is a path with a scheme, or a local one.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FrameFiles)
    options = {"path": folder if "://" in folder else f"file://{folder}", "variables": ",".join(variables), "start": start, "end": end, "step": str(step), "template": template, "block": str(block)}
    return spark.read.format("frame_files").options(**options).load()


def null_frames(read: DataFrame, cells: DataFrame) -> DataFrame:
    """What was read, with a row of null for each of cells (cell_id) in place of a row that tells an error.

    Errors are a row a file; each becomes a frame of the grid, which is the result asked for.
    """
    failed = read.where("error is not null").select("var", "time", "error")
    return read.where("error is null").unionByName(failed.join(cells.select("cell_id")).withColumn("value", F.lit(None).cast("float")))
