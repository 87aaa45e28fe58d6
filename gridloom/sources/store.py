"""Stores of observations as partitioned Parquet in numbered states: opening, keyed upserts, axes, copies, summaries."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.align import axis
from ..operators.summaries import SUMMARIES
from .commits import Commits, ConcurrentWrite

OBS = T.StructType([
    T.StructField("product", T.StringType()), T.StructField("grp", T.StringType()), T.StructField("var", T.StringType()), T.StructField("time", T.TimestampType()),
    T.StructField("level", T.IntegerType()), T.StructField("cell_id", T.LongType()), T.StructField("value", T.FloatType()), T.StructField("frame_time", T.TimestampType()),
])
KEYS = ("product", "grp", "var", "time", "level", "cell_id")
PARTITIONS = ("product", "var", "year", "month")


@dataclass(frozen=True)
class Axis:
    """A store's complete time axis."""

    start: str
    end: str
    step: str = "1 hour"

    def spine(self, spark: SparkSession) -> DataFrame:
        return axis(spark, self.start, self.end, self.step)

    def holds(self, time: Column) -> Column:
        """Whether a time is on the axis, by its distance from the start."""
        start, end = (F.lit(x).cast("timestamp") for x in (self.start, self.end))
        n, unit = self.step.split()
        if unit.rstrip("s") in ("month", "year"):
            months = F.months_between(time, start) if n == "1" and unit.startswith("month") else F.months_between(time, start) / (int(n) * (12 if unit.startswith("year") else 1))
            on = months == F.floor(months)
        else:
            micros = int(dt.timedelta(**{f"{unit.rstrip('s')}s": int(n)}) / dt.timedelta(microseconds=1))
            on = (F.unix_micros(time) - F.unix_micros(start)) % micros == 0
        return on & time.between(start, end)

    def extended(self, end: str) -> Axis:
        """With a later end; an earlier one changes nothing."""
        return Axis(self.start, end, self.step) if dt.datetime.fromisoformat(end) > dt.datetime.fromisoformat(self.end) else self

    def added(self, spark: SparkSession, end: str) -> DataFrame:
        """The times that extending to the end would add: a dry run."""
        return self.extended(end).spine(spark).join(self.spine(spark), "time", "left_anti")


@dataclass(frozen=True)
class _State:
    """What a store holds at a version: its axis, its variables, and the folder of each partition's rows and summaries."""

    version: int
    axis: Axis | None
    variables: list[list[str]]
    tables: dict[str, dict[str, str]]  # by table: partition -> folder
    grid: str | None = None

    def partitions(self, table: str, product: str | None = None, variables: list[str] | None = None) -> dict[str, str]:
        known = self.tables.get(table, {})
        fits = lambda p: (product is None or p[0] == product) and (variables is None or p[1] in variables)
        return {k: v for k, v in known.items() if fits(_values(k))}


def _values(partition: str) -> tuple[str | None, str | None, int | None, int | None]:
    """(product, var, year, month) of a partition's path."""
    of = [unquote(x.partition("=")[2]) for x in partition.split("/")]
    product, var, year, month = (None if x == "__HIVE_DEFAULT_PARTITION__" else x for x in of)
    return product, var, year and int(year), month and int(month)


class Store:
    """Observations under one path, partitioned by product, variable, year and month.

    Values that aren't there are absent rows; reindexing on the axis shows them. frame_time: when a value was seen, where
    that isn't its time.

    Every write makes a new state (Commits): its axis, its variables, its grid, and the folder that holds each partition. Folders are
    never changed, so whoever reads a state goes on reading it whatever is written meanwhile, and a write that stops halfway
    changes nothing. Of two writes that began with one state, the later one begins again with what the first has published.
    """

    def __init__(self, spark: SparkSession, path: str, times: Axis, version: int | None = None):
        self.spark, self.path, self.times, self.version = spark, path.rstrip("/"), times, version
        self.commits = Commits(spark, f"{self.path}/commits")

    def state(self) -> _State:
        v, x = self.commits.read(self.version)
        return _State(v, Axis(*x["axis"]) if x else None, x.get("variables", []), x.get("tables", {}), x.get("grid"))

    def _publish(self, before: _State, times: Axis | None = None, variables: list[list[str]] | None = None, tables: dict[str, dict[str, str]] | None = None, grid: str | None = None) -> None:
        x = {"axis": [*vars(times or before.axis or self.times).values()], "variables": variables or before.variables, "tables": tables or before.tables, "grid": grid or before.grid}
        self.commits.publish(before.version + 1, x)

    def _retried(self, write: Callable[[_State], None], tries: int = 10) -> None:
        """Write from the newest state; again from the next one if another writer was faster."""
        if self.version is not None:
            raise ValueError(f"Opened at version {self.version}, to be read only")
        for left in reversed(range(tries)):
            state = self.state()
            if state.axis is not None and state.axis != self.times:
                raise ValueError(f"The stored axis is {state.axis}, not {self.times}")
            try:
                return write(state)
            except ConcurrentWrite:
                if not left:
                    raise

    def at(self, version: int) -> Store:
        """The store as it was at a version, to be read."""
        return Store(self.spark, self.path, self.times, version)

    def _rows(self, table: str, parts: dict[str, str], schema: T.StructType) -> DataFrame:
        keys = [T.StructField(c, T.StringType() if c in KEYS else T.IntegerType()) for c in PARTITIONS]
        schema = T.StructType([*(f for f in schema.fields if f.name not in PARTITIONS), *keys])
        if not parts:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.option("basePath", f"{self.path}/{table}").schema(T.StructType([*schema.fields, T.StructField("commit", T.StringType())]))
        return read.parquet(*(f"{self.path}/{table}/{folder}/{p}" for p, folder in sorted(parts.items()))).drop("commit")

    def open(self, product: str | None = None, variables: list[str] | None = None) -> DataFrame:
        """All rows, or those of some partitions; the others aren't even listed."""
        return self._rows("data", self.state().partitions("data", product, variables), OBS)

    def check_axis(self, times: Axis) -> None:
        if times != self.times:
            raise ValueError(f"The store's axis is {self.times}, not {times}")

    def described(self) -> DataFrame:
        """(product, var, start, end, step): the axis, once a variable; empty where there is no state."""
        state = self.state()
        rows = [(*v, state.axis.start, state.axis.end, state.axis.step) for v in state.variables]
        return self.spark.createDataFrame(rows, "product string, var string, start string, end string, step string")

    def grid(self) -> DataFrame:
        """The grid that the store was created with."""
        return self.spark.read.parquet(f"{self.path}/grids/{self.state().grid}")

    def ensure(self, product: str, var: str, grid: Callable[[], DataFrame]) -> Store:
        """Create the store's first state and grid, or check the axis against the stored one and add the variable.

        Another axis than the stored one is an error. grid is called only where there is none yet. Running it again
        changes nothing.
        """

        def write(state: _State) -> None:
            name = state.grid
            if name is None:
                name = uuid.uuid4().hex
                grid().write.parquet(f"{self.path}/grids/{name}")
            if name != state.grid or [product, var] not in state.variables:
                known = [v for v in state.variables if v != [product, var]]
                self._publish(state, variables=[*known, [product, var]], grid=name)

        self._retried(write)
        return self

    def extend(self, end: str, dry_run: bool = False) -> Store | DataFrame:
        """The store with a later end of its axis, which from now on is the stored one; dry_run: the times this would add.

        An end that isn't later changes nothing. Whoever opens the store with the former axis is refused from then on; who
        reads a version goes on reading it.
        """
        if dry_run:
            return self.times.added(self.spark, end)
        longer = self.times.extended(end)
        if longer != self.times:
            self._retried(lambda state: self._publish(state, times=longer))
        return Store(self.spark, self.path, longer)

    def _written(self, df: DataFrame, table: str) -> dict[str, str]:
        """Write rows, dealt by partition, to a folder of their own: partition -> folder."""
        folder = f"commit={uuid.uuid4().hex}"
        df.write.partitionBy(*PARTITIONS).parquet(f"{self.path}/{table}/{folder}")
        return dict.fromkeys(self.commits.folders(f"{self.path}/{table}/{folder}", len(PARTITIONS)), folder)

    def _publish_or_delete(self, state: _State, table: str, done: dict[str, str], **changes) -> None:
        """Publish what was written, or delete it where that fails. A driver that dies between leaves folders no state names."""
        try:
            self._publish(state, **changes)
        except Exception:
            self._delete(table, done)
            raise

    def _delete(self, table: str, done: dict[str, str]) -> None:
        for folder in {*done.values()}:
            self.commits.delete(f"{self.path}/{table}/{folder}")

    def upsert(self, new: DataFrame, nearest: bool = False) -> None:
        """Put rows in place of those of the same keys; times off the axis and keys that new repeats are errors.

        nearest: of a key's old and new rows, the one whose frame_time is nearest to its time stays, of equally near ones the
        later; so batches may come in any order. Only partitions that get rows are read, and written once, by day and by a
        million cells. Running it again changes nothing.
        """
        new = new.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in OBS.fields))
        new = new.withColumns({"year": F.year("time"), "month": F.month("time")})
        kept = []

        def write(state: _State) -> None:
            nonlocal new
            have = state.tables.get("data", {})
            if have and not kept:
                new = new.persist(StorageLevel.DISK_ONLY)  # made once, and again where it is lost
                kept.append(new)
            touched = {tuple(r) for r in new.select(*PARTITIONS).distinct().collect()} if have else set()  # a row for each month of a variable
            old = self._rows("data", {p: f for p, f in have.items() if _values(p) in touched}, OBS)
            done = self._put(old, new, nearest)
            known = [*state.variables, *(v for v in map(list, dict.fromkeys(_values(p)[:2] for p in sorted(done))) if v not in state.variables)]
            others = {t: {p: f for p, f in x.items() if p not in done} for t, x in state.tables.items() if t != "data"}  # summaries are of what was
            if done:
                self._publish_or_delete(state, "data", done, variables=known, tables={**others, "data": {**have, **done}})

        try:
            self._retried(write)
        finally:
            for df in kept:
                df.unpersist()

    def _put(self, old: DataFrame, new: DataFrame, nearest: bool) -> dict[str, str]:
        """Write old and new rows, checked on the way: partition -> folder."""
        if nearest:
            gap = F.abs(F.unix_micros("frame_time") - F.unix_micros("time"))
            best = F.min_by(F.struct("value", "frame_time"), F.struct(F.coalesce(gap, F.lit(1 << 62)), -F.unix_micros("frame_time"), "value"))
        else:
            best = F.max_by(F.struct("value", "frame_time"), "_new")
        both = old.select(*new.columns, F.lit(0).alias("_new")).unionByName(new.withColumn("_new", F.lit(1)))
        place = {"_day": F.dayofmonth("time"), "_block": F.floor(F.col("cell_id") / 1_000_000)}
        dealt = both.withColumns(place).repartition(*PARTITIONS, *place)  # the grouping keeps this layout
        rows = dealt.groupBy(*KEYS, "year", "month", *place).agg(best.alias("best"), F.sum("_new").alias("_new"))
        seen = Observation()
        off = F.max((F.col("_new") > 0) & ~F.coalesce(self.times.holds(F.col("time")), F.lit(False)))
        rows = rows.observe(seen, F.max("_new").alias("most"), off.alias("off"))
        done = self._written(rows.select(*KEYS, "year", "month", "best.*").sortWithinPartitions(*PARTITIONS, "time", "cell_id"), "data")
        found = seen.get
        if found["off"] or (found["most"] or 0) > 1:
            self._delete("data", done)
            raise ValueError("Times off the store's axis" if found["off"] else "Repeated key")
        return done

    def summary(self, kind: str, product: str | None = None, variables: list[str] | None = None) -> DataFrame:
        """Summaries of a kind (operators.summaries) by partition; those that aren't there yet are made, once.

        Only partitions written since are read for it, so a month's upsert costs that month's rows.
        """
        of, schema = SUMMARIES[kind]

        def write(state: _State) -> None:
            have = state.tables.get(kind, {})
            due = {p: f for p, f in state.partitions("data", product, variables).items() if p not in have}
            if due:
                done = self._written(of(self._rows("data", due, OBS), *PARTITIONS), kind)
                self._publish_or_delete(state, kind, done, tables={**state.tables, kind: {**have, **done}})

        if self.version is None:
            self._retried(write)
        return self._rows(kind, self.state().partitions(kind, product, variables), schema)

    def expire(self, keep: int = 1) -> None:
        """Delete all states but the newest ones, and the folders that only deleted states name."""
        versions = self.commits.versions()
        gone, stay = [self.at(v).state().tables for v in versions[keep:]], [self.at(v).state().tables for v in versions[:keep]]
        named = lambda states: {f"{self.path}/{t}/{f}" for x in states for t, parts in x.items() for f in parts.values()}
        for v in versions[keep:]:
            self.commits.drop(v)
        for folder in named(gone) - named(stay):
            self.commits.delete(folder)

    def copy_to(self, other: Store, start: str, end: str, variables: list[str]) -> None:
        """A time range of some variables into another store."""
        other.upsert(self.open(variables=variables).where(F.col("time").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))).drop("year", "month"))


def replaced(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Rows of new, and those of old whose keys new lacks."""
    return old.join(new.select(*keys), [*keys], "left_anti").unionByName(new.select(*old.columns))


def merged(parts: list[DataFrame], files: int | None = None) -> DataFrame:
    """Per-year tables as one, in files sorted by time and cell."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.repartition(files, "time") if files else out
    return out.sortWithinPartitions("time", "cell_id")


def rechunk(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """In n files by the keys, sorted by time and cell."""
    return df.repartition(n, *keys).sortWithinPartitions("time", "cell_id")
