"""Stores in numbered states, and the summaries they keep."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import summaries
from gridloom.sources import store
from gridloom.sources.commits import Commits, ConcurrentWrite

YEAR = store.Axis("2024-01-01 00:00:00", "2024-12-31 23:00:00")


def obs(spark, rows):
    return spark.createDataFrame(rows, "product string, var string, t string, cell_id long, value double").withColumn("time", F.to_timestamp("t")).drop("t")


def held(s):
    return sorted((r[0], r[1], r[2], r[3]) for r in s.open().select("var", F.col("time").cast("string"), "cell_id", "value").collect())


JAN, FEB = ("p", "t2", "2024-01-01 00:00:00", 1, 1.0), ("p", "t2", "2024-02-01 00:00:00", 1, 2.0)


class Stopped(RuntimeError):
    pass


def test_a_write_that_stops_before_it_is_published_changes_nothing(spark, tmp_path, monkeypatch):
    s = store.Store(spark, str(tmp_path / "s"), YEAR)
    s.upsert(obs(spark, [JAN, FEB]))
    before, written = held(s), []

    def stop(self, version, state):
        written.extend(os.listdir(tmp_path / "s" / "data"))
        raise Stopped

    with monkeypatch.context() as m, pytest.raises(Stopped):
        m.setattr(Commits, "publish", stop)
        s.upsert(obs(spark, [(*JAN[:4], 9.0), ("p", "t2", "2024-03-01 00:00:00", 1, 3.0)]))
    assert len(written) == 2 and held(s) == before and s.state().version == 1
    s.upsert(obs(spark, [(*JAN[:4], 9.0)]))
    assert [r[3] for r in held(s)] == [9.0, 2.0]


def test_of_two_writers_of_a_month_none_loses_rows(spark, tmp_path, monkeypatch):
    s = store.Store(spark, str(tmp_path / "s"), YEAR)
    s.upsert(obs(spark, [JAN]))
    publish, between = Commits.publish, [("p", "t2", "2024-01-01 01:00:00", 1, 5.0)]

    def late(self, version, state):
        if between:  # another writer is faster
            rows = [between.pop()]
            store.Store(spark, s.path, YEAR).upsert(obs(spark, rows))
        publish(self, version, state)

    with monkeypatch.context() as m:
        m.setattr(Commits, "publish", late)
        s.upsert(obs(spark, [("p", "t2", "2024-01-01 02:00:00", 1, 6.0)]))
    assert [r[3] for r in held(s)] == [1.0, 5.0, 6.0] and s.state().version == 3
    with pytest.raises(ConcurrentWrite):
        s.commits.publish(3, {})
    assert [f for f in os.listdir(tmp_path / "s" / "commits") if f.startswith(".") and not f.endswith(".crc")] == []


def test_states_are_read_as_they_were_until_they_expire(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"), YEAR)
    s.upsert(obs(spark, [JAN, FEB]))
    s.upsert(obs(spark, [(*JAN[:4], 7.0)]))
    assert [[r[3] for r in held(s.at(v))] for v in (1, 2)] == [[1.0, 2.0], [7.0, 2.0]]
    with pytest.raises(ValueError, match="read only"):
        s.at(1).upsert(obs(spark, [JAN]))
    parts = [s.at(v).state().tables["data"] for v in (1, 2)]
    same = {p for p in parts[0] if parts[0][p] == parts[1][p]}
    assert same == {"product=p/var=t2/year=2024/month=2"}  # a month that gets no rows keeps its folder
    with open(tmp_path / "s" / "commits" / f"{3:020d}.json", "w") as f:
        f.write("00000000\n{}")  # no valid state: passed over
    assert s.state().version == 2
    os.remove(tmp_path / "s" / "commits" / f"{3:020d}.json")
    s.upsert(obs(spark, [(*JAN[:4], 8.0)]))
    s.expire(keep=1)
    assert s.commits.versions() == [3] and [r[3] for r in held(s)] == [8.0, 2.0]
    assert len(os.listdir(tmp_path / "s" / "data")) == 2


def test_an_axis_grows_in_the_store(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"), store.Axis("2024-01-01 00:00:00", "2024-01-31 23:00:00"))
    s.upsert(obs(spark, [JAN]))
    assert s.extend("2024-01-15 00:00:00").times == s.times and s.state().version == 1
    assert s.extend("2024-02-01 01:00:00", dry_run=True).count() == 2 and s.state().version == 1
    longer = s.extend("2024-02-29 23:00:00")
    with pytest.raises(ValueError, match="off"):
        longer.upsert(obs(spark, [("p", "t2", "2024-03-01 00:00:00", 1, 2.0)]))
    longer.upsert(obs(spark, [FEB]))
    with pytest.raises(ValueError, match="stored axis"):
        s.upsert(obs(spark, [JAN]))
    with pytest.raises(ValueError, match="stored axis"):
        s.ensure("p", "u", lambda: obs(spark, [JAN]))
    assert len(held(store.Store(spark, s.path, longer.times))) == 2 and len(held(s.at(1))) == 1


@pytest.mark.parametrize("step,on,off", [("5 minutes", "2024-01-03 00:35:00", "2024-01-03 00:36:00"), ("1 day", "2024-02-01 00:00:00", "2024-02-01 01:00:00"), ("1 month", "2024-03-01 00:00:00", "2024-03-02 00:00:00"), ("3 months", "2024-04-01 00:00:00", "2024-03-01 00:00:00")])
def test_an_axis_holds_its_times(spark, step, on, off):
    axis = store.Axis("2024-01-01 00:00:00", "2024-06-30 00:00:00", step)
    x = spark.createDataFrame([(on,), (off,), ("2025-01-01 00:00:00",), (None,)], "t string").select(axis.holds(F.to_timestamp("t")).alias("h"))
    assert [r["h"] for r in x.collect()] == [True, False, False, None]
    assert axis.spine(spark).where(~axis.holds(F.col("time"))).count() == 0


def values(spark, months, seed=1):
    rng = random.Random(seed)
    rows = [("p", var, f"2024-{m:02d}-{day:02d} {h:02d}:00:00", c, round(rng.gauss(1e5, 3), 3)) for m in months for day in (1, 2) for h in (0, 6) for c in (0, 1, 7, 32768, 32769, 70000) for var in ("t2", "tp") if rng.random() < 0.8]
    return obs(spark, rows)


def test_summaries_follow_upserts_month_by_month(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"), YEAR)
    s.upsert(values(spark, range(1, 5)))
    s.summary("moments")
    before = s.state().tables["moments"]
    s.upsert(values(spark, [3], seed=2))
    got = {r["var"]: r for r in summaries.merged_moments(s.summary("moments"), "var").collect()}
    after = s.state().tables["moments"]
    assert {p for p in after if after[p] != before[p]} == {f"product=p/var={v}/year=2024/month=3" for v in ("t2", "tp")}
    for var, of in {v: np.array([r["value"] for r in s.open(variables=[v]).collect()], float) for v in ("t2", "tp")}.items():
        r = got[var]
        assert r["n"] == len(of) and abs(r["std"] - of.std()) < 1e-9 and abs(r["mean"] - of.mean()) < 1e-9 and (r["min"], r["max"]) == (of.min(), of.max())
    known = s.state().version
    s.summary("moments").count()
    assert s.state().version == known  # nothing is due


def test_presence_tells_cells_without_values(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"), YEAR)
    x = values(spark, [1, 2])
    s.upsert(x)
    bits = s.summary("presence")
    plan = bits._jdf.queryExecution().executedPlan().toString()
    assert "value" not in plan and "bits" in plan
    want = {(r["var"], r["time"]): r["n"] for r in x.groupBy("var", "time").agg(F.count("value").alias("n")).collect()}
    assert {(r["var"], r["time"]): r["n"] for r in summaries.present(bits, "var", "time").collect()} == want
    day = F.to_date("time").alias("day")
    ever = {tuple(r) for r in summaries.cells_of(summaries.cells_ever(bits.withColumn("day", day), "var", "day"), "var", "day").collect()}
    assert ever == {tuple(r) for r in x.select("var", day, "cell_id").distinct().collect()}
    rows = x.select("var", "time", "cell_id").collect()
    times = {}
    for r in rows:
        times.setdefault(r["var"], {}).setdefault(r["cell_id"], set()).add(r["time"])
    always = {(v, c) for v, cells in times.items() for c, ts in cells.items() if all((v, t) in want and t in ts for (w, t) in want if w == v)}
    got = {tuple(r) for r in summaries.cells_of(summaries.cells_always(bits, "var"), "var").collect()}
    assert always <= got  # blocks without any cell at a time have no row, so their cells can only be more


def test_sketches_keep_ranks(spark):
    rng = np.random.default_rng(3)
    x = rng.lognormal(0, 2, 200_000)
    df = spark.createDataFrame([(k % 5, float(v)) for k, v in enumerate(x)], "part int, value double")
    parts = summaries.sketched(df, "part", size=400).withColumn("var", F.lit("v"))
    got = summaries.merged_quantiles(parts, "var", size=400).collect()
    ordered = np.sort(x)
    off = [abs(np.searchsorted(ordered, r["value"], "right") / len(x) - r["percentile"] / 100) for r in got]
    assert len(off) == 100 and max(off) < 2.3 / 400**0.9 * 2.0
