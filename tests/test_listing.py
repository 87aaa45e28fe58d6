"""Listings of folders, dependencies of dependencies, bounds and types of catalogue rows."""

import pytest
from pyspark.sql import functions as F

from gridloom.operators import select
from gridloom.sources import listing


def test_listing_opens_no_file(spark, tmp_path):
    for day in ("2024-01-31", "2024-02-01", "2024-02-02"):
        (tmp_path / f"day={day}" / "deep").mkdir(parents=True)
        (tmp_path / f"day={day}" / "deep" / f"x_{day.replace('-', '')}.grib2").write_bytes(b"x" * 10)
        (tmp_path / f"day={day}" / "notes.txt").write_bytes(b"n")
        (tmp_path / f"day={day}" / "nothing.grib2").write_bytes(b"")
    x = listing.listed(spark, str(tmp_path), "day=2024-02-*", names="*.grib2")
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "length" in plan
    assert sorted((str(r["d"]), r["size"]) for r in x.withColumn("d", listing.date_of_path(F.element_at(F.split("path", "/"), -1))).collect()) == [("2024-02-01", 10), ("2024-02-02", 10)]
    assert listing.listed(spark, str(tmp_path)).count() == 6


def closure_by_hand(deps, var, path=()):
    if var in path:
        raise ValueError(var)
    return {p for v, p in deps if v == var} | {q for v, p in deps if v == var for q in closure_by_hand(deps, p, (*path, var))}


def test_dependencies_of_dependencies(spark):
    deps = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("d", "f"), ("x", "e")]
    df = spark.createDataFrame([*deps, deps[0]], "var string, part string")
    rows = select.all_parts(df).collect()
    got = {}
    for r in rows:
        got.setdefault(r["var"], set()).add(r["part"])
    assert got == {v: closure_by_hand(deps, v) for v in "abcdx"}
    level = {r["part"]: r["level"] for r in rows}
    assert all(level.get(p, 0) < level[v] for v, p in deps if v in level)
    wanted = spark.createDataFrame([(1, "a"), (1, "x"), (2, "e")], "k int, var string")
    of = {}
    for r in select.needed(wanted, df, "k").orderBy("level").collect():
        of.setdefault(r["k"], []).append(r["var"])
    assert set(of[1]) == set("abcdefx") and of[1].index("a") > of[1].index("b") > of[1].index("d") > of[1].index("e") and of[2] == ["e"]
    for loop in ([("a", "b"), ("b", "c"), ("c", "a")], [("a", "a")]):
        with pytest.raises(ValueError, match="needs itself"):
            select.all_parts(spark.createDataFrame(loop, "var string, part string"))


def test_bounds_and_types_of_rows(spark):
    x = spark.createDataFrame([("2024-01-01", "2024-01-02"), ("2024-01-01 05:00:00", "2024-01-01 06:00:00")], "a string, b string")
    got = [(str(r[0]), str(r[1])) for r in x.select(*(c.cast("string") for c in select.period_bounds(F.col("a"), F.col("b")))).collect()]
    assert got == [("2024-01-01 00:00:00", "2024-01-02 23:00:00"), ("2024-01-01 05:00:00", "2024-01-01 06:00:00")]
    assert [tuple(map(str, select.process_bounds(*r))) for r in x.collect()] == got
    with pytest.raises(Exception, match="before start"):
        spark.createDataFrame([("2024-01-03", "2024-01-01")], "a string, b string").select(*select.period_bounds(F.col("a"), F.col("b"))).collect()
    types = spark.createDataFrame([("k", "p"), ("k", "p"), ("m", "q")], "v string, kind string")
    assert {tuple(r) for r in select.single_types(types, "kind", "v").collect()} == {("k", "p"), ("m", "q")}
    with pytest.raises(Exception, match="Several kinds"):
        select.single_types(types.union(spark.createDataFrame([("k", "z")], types.schema)), "kind", "v").collect()


def test_needed_in_order_holds_no_lists_by_key(spark):
    """More variables than bits of a number, and keys that want several."""
    parts = [f"v{i:03}" for i in range(140)]
    deps = spark.createDataFrame([*(("top", v) for v in parts), ("over", "top")], "var string, part string")
    wanted = spark.createDataFrame([(1, "v138"), (1, "v139"), (2, "over"), (2, "v007"), (3, "alone"), (3, "top")], "k long, var string")
    got = select.needed_in_order(wanted, deps, "k")
    assert {r["k"]: r["need"] for r in got.collect()} == {1: ["v138", "v139"], 2: [*parts, "top", "over"], 3: ["alone", *parts, "top"]}
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()
