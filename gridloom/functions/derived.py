"""Variables made of others: names, what they need, and how."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.stats import wide
from .weather import geopotential_height, total_precipitation, wind_direction, wind_speed


@dataclass(frozen=True)
class Derived:
    parts: tuple[str, ...]
    make: Callable[..., Column]


DERIVED = {
    "si10": Derived(("u10", "v10"), wind_speed),
    "wdir10": Derived(("u10", "v10"), wind_direction),
    "tp": Derived(("lsp", "cp"), total_precipitation),
    "orog": Derived(("z",), geopotential_height),
}


def with_derived(df: DataFrame, *names: str) -> DataFrame:
    """A wide table with derived columns."""
    return df.withColumns({n: DERIVED[n].make(*(F.col(p) for p in DERIVED[n].parts)) for n in names})


def derive_when_complete(obs: DataFrame, name: str, least: int) -> DataFrame:
    """(time, cell_id, value) of a derived variable, of the days on which each of its parts has at least so many values."""
    parts = DERIVED[name].parts
    mine = obs.where(F.col("var").isin(*parts))
    counts = mine.groupBy(F.to_date("time").alias("_day"), "var").agg(F.count("value").alias("n")).where(F.col("n") >= least)
    ready = counts.groupBy("_day").agg(F.count("*").alias("k")).where(F.col("k") == len(parts)).select("_day")
    x = mine.withColumn("_day", F.to_date("time")).join(F.broadcast(ready), "_day", "left_semi")
    return with_derived(wide(x, [*parts]), name).where(F.col(name).isNotNull()).select("time", "cell_id", F.col(name).alias("value"))
