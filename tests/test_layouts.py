"""Frame files with errors, tiles, and slots that late frames correct."""

import datetime as dt
import glob
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridloom.operators import align, regrid
from gridloom.sources import framefiles, store, tiles
from gridloom.streaming import frames as stream


@pytest.fixture
def ten(tmp_path):
    """Ten hours of two variables; of u, 03 is cut off, 05 is missing, 07 lacks a column and 08 holds text."""
    for var in ("u", "v"):
        (tmp_path / var / "20240101").mkdir(parents=True)
        for h in range(10):
            pq.write_table(pa.table({"cell_id": [1, 2], "value": [float(h), None]}), tmp_path / var / "20240101" / f"{h:02d}00.parquet")
    u = tmp_path / "u" / "20240101"
    (u / "0300.parquet").write_bytes((u / "0300.parquet").read_bytes()[:-20])
    (u / "0500.parquet").unlink()
    pq.write_table(pa.table({"cell_id": [1]}), u / "0700.parquet")
    pq.write_table(pa.table({"cell_id": [1], "value": ["x"]}), u / "0800.parquet")
    return str(tmp_path)


def opened(spark, ten, block=4):
    return framefiles.read_frames(spark, ten, ["u", "v"], "2024-01-01 00:00:00", "2024-01-01 09:00:00", block=block)


def test_unreadable_files_are_rows(spark, ten):
    x = opened(spark, ten)
    assert x.where("error is null").count() == 2 * 10 * 2 - 4 * 2
    errors = {(r[0], r[1].hour): r[4] for r in x.where("error is not null").collect()}
    assert sorted(errors) == [("u", 3), ("u", 5), ("u", 7), ("u", 8)] and errors["u", 5] == "missing"
    assert all(r.cell_id is None and r.value is None for r in x.where("error is not null").collect())
    full = framefiles.null_frames(x, spark.createDataFrame([(1,), (2,), (3,)], "cell_id long"))
    assert full.where("error is not null").count() == 4 * 3
    assert full.where("var = 'u' and hour(time) = 4").count() == 2


def test_filters_leave_files_closed(spark, ten):
    x = opened(spark, ten, block=1).where("var = 'v' and time >= timestamp'2024-01-01 02:30:00' and time < timestamp'2024-01-01 05:00:00'")
    assert {r.time.hour for r in x.collect()} == {3, 4}
    assert x.rdd.getNumPartitions() == 3  # 03, 04, and 05 that Spark itself drops
    assert opened(spark, ten).where("var = 'w'").count() == 0
    assert opened(spark, ten).where("time > timestamp'2025-01-01 00:00:00'").count() == 0
    assert opened(spark, ten).where("time = timestamp'2024-01-01 04:00:00'").count() == 4


def test_hilbert_is_a_walk(spark):
    n = 16
    x = spark.range(n * n).select((F.col("id") / n).cast("int").alias("y"), (F.col("id") % n).cast("int").alias("x"))
    place = {r.d: (r.y, r.x) for r in x.select("y", "x", tiles.hilbert(F.col("y"), F.col("x"), 4).alias("d")).collect()}
    assert sorted(place) == list(range(n * n))
    assert all(abs(place[d][0] - place[d + 1][0]) + abs(place[d][1] - place[d + 1][1]) == 1 for d in range(n * n - 1))


def test_box_reads_few_files(spark, tmp_path):
    cells = spark.range(64 * 64).select((F.col("id") / 64).cast("int").alias("y"), (F.col("id") % 64).cast("int").alias("x"))
    x = align.axis(spark, "2024-01-01 00:00:00", "2024-01-08 18:00:00", "6 hours").join(cells).withColumn("value", F.xxhash64("time", "y", "x").cast("double"))
    path = str(tmp_path / "t")
    tiles.write_tiles(x, path, block=8, files=64)
    ask = ("2024-01-03 06:00:00", "2024-01-04 00:00:00", (10, 20), (30, 41))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    got = tiles.read_box(spark, path, *ask, block=8)
    want = x.where("time between timestamp'2024-01-03 06:00:00' and timestamp'2024-01-04 00:00:00' and y between 10 and 20 and x between 30 and 41")
    assert got.count() == want.count() == 4 * 11 * 12 and got.exceptAll(want.select(got.columns)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(span" in pushed and "GreaterThanOrEqual(tile" in pushed
    tile = [r[0] for r in x.where("y between 10 and 20 and x between 30 and 41").select(tiles.tile_of(F.col("y"), F.col("x"), 8)).distinct().collect()]
    met = 0
    for f in (files := glob.glob(f"{path}/*.parquet")):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        (s0, s1), (t0, t1) = ((s.min, s.max) for s in (meta.row_group(0).column(names.index(c)).statistics for c in ("span", "tile")))
        met += s0 <= 19726 and s1 >= 19725 and any(t0 <= t <= t1 for t in tile)
    assert len(files) >= 60 and 0 < met <= 10  # of 16 files of the two days; statistics leave the others unread


def test_ranges_hold_all_tiles():
    rnd = random.Random(3)
    for n in (0, 1, 5, 200):
        ts = rnd.sample(range(1000), n)
        for most in (1, 3, 64):
            out = tiles._ranges(ts, most)
            assert len(out) <= most and all(any(a <= t <= b for a, b in out) for t in ts)


def test_late_frames_correct_slots(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(dt.datetime(2024, 1, 1, tzinfo=dt.UTC) + dt.timedelta(seconds=rnd.randrange(7200)), c, float(k)) for k in range(400) for c in (1, 2)]
    f = spark.createDataFrame(rows, "ts timestamp, cell_id long, value double")
    f.repartition(4, "value").write.parquet(str(tmp_path / "in"))  # every file holds frames of all times
    s = store.Store(spark, str(tmp_path / "store"), store.Axis("2024-01-01 00:00:00", "2024-01-01 23:55:00", "5 minutes"))
    seen = []

    def put(df):
        seen.append(df.count())
        s.upsert(df.select(F.lit("radar").alias("product"), F.lit("rate").alias("var"), F.col("slot").alias("time"), "cell_id", "value", "frame_time"))

    for _ in range(2):  # started again, it takes nothing twice
        st = spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        assert stream.follow(st, put, str(tmp_path / "ck")).awaitTermination(120)
    got = {tuple(r) for r in s.open().select(F.col("time").cast("string"), "cell_id", F.col("value").cast("double")).collect()}
    want = {tuple(r) for r in align.snapped_frames(f).select(F.col("slot").cast("string"), "cell_id", "value").collect()}
    assert got == want and sum(seen) > len(want)  # slots were given out again


def test_frames_are_shuffled_once(spark):
    cells = spark.range(64).select(F.col("id").alias("cell_id"), (F.col("id") / 8).cast("int").alias("y"), (F.col("id") % 8).cast("int").alias("x"))
    grid = cells.withColumns({"latitude": F.lit(40.0) + F.col("y"), "longitude": F.lit(270.0) + F.col("x")})
    points = grid.where("y < 7 and x < 7").select(F.col("cell_id").alias("dst_cell"), (F.col("latitude") + 0.3).alias("latitude"), (F.col("longitude") + 0.6).alias("longitude"))
    w = regrid.bilinear_weights(grid, points)
    x = align.axis(spark, "2024-01-01 00:00:00", "2024-01-01 05:00:00").join(cells).where("cell_id <> 9 or hour(time) > 2")
    x = x.select("time", "cell_id", F.when(F.col("cell_id") != 20, F.hour("time") * 100.0 + F.col("y") * 2 + F.col("x")).alias("value"))
    rows = lambda df: sorted((str(r.time), r.cell_id, None if r.value is None else round(r.value, 9)) for r in df.collect())
    want = rows(regrid.regrid(x, w, "time"))
    assert rows(regrid.regrid_frames(x, w, "time")) == want and rows(regrid.regrid_frames(x, w, "time", most_weights=3)) == want
    assert len(want) == 6 * 49 and any(r[2] is None for r in want)
    kept = spark.createDataFrame(w.collect(), w.schema)
    plan = regrid.regrid_frames(x, kept, "time")._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("BroadcastHashJoin")]
    assert "Exchange hashpartitioning" not in after  # the sums need no shuffle behind the join
