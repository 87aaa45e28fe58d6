import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.operators import align, audit, regrid, registry, select, stats
from gridloom.plans import windows
from gridloom.sources import store, tables
from gridloom.streaming import frames as stream


def times(df, c="time"):
    return [str(r[0]) for r in df.select(F.col(c).cast("string")).orderBy(c).collect()]


def grid(spark, ny=4, nx=5, lat0=40.0, lon0=278.0, down=False):
    rows = [(y * nx + x, y, x, lat0 + (-0.5 if down else 0.5) * y, lon0 + 0.25 * x) for y in range(ny) for x in range(nx)]
    return spark.createDataFrame(rows, "cell_id long, y int, x int, latitude double, longitude double")


def test_box_conventions(spark):
    g = grid(spark)
    assert select.crop_box(g, 40.0, 40.5, -82.0, -81.75).count() == 4
    west = g.withColumn("longitude", F.col("longitude") - 360)
    assert select.crop_box(west, 40.0, 40.5, -82.0, -81.75).count() == 4
    with pytest.raises(Exception, match="No grid cell"):
        select.crop_rectangle(g, 0.0, 1.0, 0.0, 1.0).collect()


def test_partial_dates():
    assert select.partial_end("2024") == ("2025-01-01 00:00:00", True)
    assert select.partial_end("2023-12") == ("2024-01-01 00:00:00", True)
    assert select.partial_end("2024-02-28") == ("2024-02-29 00:00:00", True)
    assert select.partial_end("2024-02-28T05:00:00") == ("2024-02-28 05:00:00", False)
    assert select.partial_start("2024") == "2024-01-01 00:00:00" and select.partial_start("2024-03") == "2024-03-01 00:00:00"
    assert select.process_bounds("2024-01-01", "2024-01-02")[1] == dt.datetime(2024, 1, 2, 23)
    with pytest.raises(ValueError, match="before"):
        select.process_bounds("2024-01-03", "2024-01-02")


def test_levels(spark):
    df = spark.createDataFrame([(500,), (850,), (1000,)], "level int")
    assert sorted(r[0] for r in select.select_levels(df, [850.0000001, 500, 500]).collect()) == [500, 850]
    with pytest.raises(ValueError, match="not found"):
        select.select_levels(df, [501])
    with pytest.raises(ValueError, match="Not constant"):
        select.squeeze(df, "level")


def test_dependencies(spark):
    deps = {"si10": ["u10", "v10"], "wdir10": ["u10", "v10"]}
    assert select.expand_dependencies(["si10", "wdir10", "tp"], deps) == ["u10", "v10", "si10", "wdir10", "tp"]
    assert select.expand_dependencies(["si10", "tp"], deps, keep=False) == ["u10", "v10", "tp"]
    listed = spark.createDataFrame([(["si10", "wdir10", "tp"],), ([],)], "v array<string>")
    assert [r[0] for r in listed.select(select.with_dependencies(F.col("v"), deps)).collect()] == [["u10", "v10", "si10", "wdir10", "tp"], []]
    assert listed.select(select.with_dependencies(F.col("v"), deps, keep=False)).first()[0] == ["u10", "v10", "tp"]
    assert select.single_type({"a": "x", "b": "x"}, ["a", "b"]) == "x"
    with pytest.raises(ValueError, match="several"):
        select.single_type({"a": "x", "b": "y"}, ["a", "b"])


def frame_table(spark, rows):
    return spark.createDataFrame(rows, "t string, cell_id long, value double").select(F.to_timestamp("t").alias("ts"), "cell_id", "value")


def test_slots(spark):
    f = frame_table(spark, [("2024-01-01 00:05:00", 1, 1.0), ("2024-01-01 00:06:59", 1, 2.0), ("2024-01-01 00:12:00", 1, 3.0), ("2024-01-01 00:12:01", 1, 4.0), ("2024-01-01 00:17:30", 1, 5.0), ("2024-01-01 00:08:01", 1, 6.0)])
    got = {str(r[0]): r[2] for r in align.snapped_frames(f).select(F.col("slot").cast("string"), "cell_id", "value").collect()}
    assert got == {"2024-01-01 00:05:00": 1.0, "2024-01-01 00:10:00": 6.0}
    tie = frame_table(spark, [("2024-01-01 00:04:00", 1, 1.0), ("2024-01-01 00:06:00", 1, 2.0)])
    assert align.snapped_frames(tie).first().value == 2.0
    slots = align.axis(spark, "2024-01-01 00:00:00", "2024-01-01 00:20:00", "5 minutes").withColumnRenamed("time", "slot")
    near = {str(r[0]): r[1] for r in align.nearest_in_time(f, slots, 120, 300).select(F.col("slot").cast("string"), "value").collect()}
    assert near == got


def test_stream_agrees_with_batch(spark, tmp_path):
    rows = [(f"2024-01-01 {h:02d}:{m:02d}:{(m * 7) % 60:02d}", c, float(h * 60 + m + c)) for h in range(3) for m in range(0, 60, 2) for c in (1, 2)]
    f = frame_table(spark, rows)
    f.write.parquet(str(tmp_path / "in"))
    st = spark.readStream.schema(f.schema).parquet(str(tmp_path / "in"))
    q = stream.slot_stream(st).writeStream.outputMode("append").format("memory").queryName("slots").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    got = {tuple(r) for r in spark.sql("select cast(slot as string), cell_id, value from slots").collect()}
    want = {tuple(r) for r in align.snapped_frames(f).select(F.col("slot").cast("string"), "cell_id", "value").collect()}
    assert got and got <= want and len(want) - len(got) <= 8


def test_ingest_upserts(spark, tmp_path):
    f = frame_table(spark, [("2024-01-01 00:05:10", 1, 1.0), ("2024-01-01 00:10:10", 2, 2.0)])
    f.write.parquet(str(tmp_path / "in"))
    s = store.Store(spark, str(tmp_path / "store"), store.Axis("2024-01-01 00:00:00", "2024-01-01 23:55:00", "5 minutes"))
    put = lambda df: s.upsert(df.select(F.lit("radar").alias("product"), F.lit("rate").alias("var"), F.col("slot").alias("time"), "cell_id", "value"))
    for _ in range(2):
        stream.ingest(spark.readStream.schema(f.schema).parquet(str(tmp_path / "in")), put, str(tmp_path / "ck")).awaitTermination(120)
    assert s.open().count() == 2


def test_store(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"), store.Axis("2024-01-01 00:00:00", "2024-02-29 23:00:00"))
    obs = lambda rows: spark.createDataFrame(rows, "product string, var string, t string, cell_id long, value double").withColumn("time", F.to_timestamp("t")).drop("t")
    first = obs([("p", "u10", "2024-01-01 00:00:00", 1, 1.0), ("p", "u10", "2024-02-01 00:00:00", 1, 2.0), ("p", "v10", "2024-01-01 00:00:00", 1, 3.0)])
    for _ in range(2):  # again changes nothing
        s.upsert(first)
    s.upsert(obs([("p", "u10", "2024-01-01 00:00:00", 1, 9.0), ("p", "u10", "2024-01-01 01:00:00", 1, 8.0)]))
    got = sorted((r.var, str(r.time), r.value) for r in s.open("p").select("var", F.col("time").cast("string").alias("time"), "value").collect())
    assert got == [("u10", "2024-01-01 00:00:00", 9.0), ("u10", "2024-01-01 01:00:00", 8.0), ("u10", "2024-02-01 00:00:00", 2.0), ("v10", "2024-01-01 00:00:00", 3.0)]
    with pytest.raises(ValueError, match="off"):
        s.upsert(obs([("p", "u10", "2024-01-01 00:30:00", 1, 9.0)]))
    with pytest.raises(ValueError, match="axis"):
        s.check_axis(store.Axis("2024-01-01 00:00:00", "2024-03-01 00:00:00"))
    other = store.Store(spark, str(tmp_path / "o"), s.times)
    s.copy_to(other, "2024-01-01 00:00:00", "2024-01-31 23:00:00", ["u10"])
    assert other.open().count() == 2
    with pytest.raises(ValueError, match="Repeated"):
        s.upsert(obs([("p", "u10", "2024-01-01 00:00:00", 1, 9.0), ("p", "u10", "2024-01-01 00:00:00", 1, 8.0)]))
    assert s.times.extended("2024-01-05 00:00:00") == s.times and s.times.added(spark, "2024-03-01 01:00:00").count() == 2


def test_stores_are_ensured(spark, tmp_path):
    calls = []
    template = lambda: calls.append(1) or grid(spark)
    of = lambda end: store.Store(spark, str(tmp_path / "s"), store.Axis("2024-01-01 00:00:00", end))
    for var in ("u10", "v10", "u10"):
        s = of("2024-01-02 00:00:00").ensure("p", var, template)
    assert sorted(r["var"] for r in s.described().collect()) == ["u10", "v10"] and s.grid().count() == 20 and calls == [1]
    with pytest.raises(ValueError, match="stored axis"):
        of("2024-01-03 00:00:00").ensure("p", "u10", template)


def test_nearest_frame_stays_over_batches(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "store"), store.Axis("2024-01-01 00:00:00", "2024-01-01 23:55:00", "5 minutes"))
    put = lambda df: s.upsert(df.select(F.lit("radar").alias("product"), F.lit("rate").alias("var"), F.col("slot").alias("time"), "cell_id", "value", "frame_time"), nearest=True)
    landed = [[("2024-01-01 00:05:05", 1, 1.0), ("2024-01-01 00:11:00", 1, 5.0)], [("2024-01-01 00:06:40", 1, 9.0), ("2024-01-01 00:10:20", 1, 6.0), ("2024-01-01 00:15:00", 2, 7.0)]]
    for rows in landed:
        frame_table(spark, rows).write.mode("append").parquet(str(tmp_path / "in"))
        stream.ingest(spark.readStream.schema("ts timestamp, cell_id long, value double").parquet(str(tmp_path / "in")), put, str(tmp_path / "ck")).awaitTermination(120)
    got = {(str(r[0]), r[1], r[2]) for r in s.open().select(F.col("time").cast("string"), "cell_id", "value").collect()}
    want = {(str(r[0]), r[1], r[2]) for r in align.snapped_frames(frame_table(spark, sum(landed, []))).select(F.col("slot").cast("string"), "cell_id", "value").collect()}
    assert got == want and len(got) == 3


def test_numbered(spark):
    from gridloom.sources import sinks

    df = spark.createDataFrame([(None if k % 5 == 0 else f"f{k % 7}", k) for k in range(500)], "family string, k int").repartition(6)
    got = sinks.numbered(df, "family", "k").orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, 501)) and [(r["family"], r["k"]) for r in got] == sorted(((r["family"], r["k"]) for r in got), key=lambda r: (r[0] is None, r[0] or "", r[1]))


def test_audits(spark):
    spine = align.axis(spark, "2024-01-01 00:00:00", "2024-01-01 03:00:00")
    obs = spark.createDataFrame([("u10", "2024-01-01 00:00:00", 1, 1.0), ("u10", "2024-01-01 00:00:00", 2, 1.0), ("u10", "2024-01-01 01:00:00", 1, 1.0)], "var string, t string, cell_id long, value double").withColumn("time", F.to_timestamp("t"))
    assert times(audit.missing_times(obs, spine, 2, ["u10"])) == ["2024-01-01 01:00:00", "2024-01-01 02:00:00", "2024-01-01 03:00:00"]
    w = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "window string, n_times int")
    x = obs.withColumn("window", F.when(F.hour("time") == 0, "c").otherwise("a"))
    got = {(r.var, r.window): r.status for r in audit.fill_status(x, w, 2, ["u10", "tp"]).collect()}
    assert got == {("u10", "a"): "partial", ("u10", "b"): "empty", ("u10", "c"): "full", ("tp", "a"): "missing_var", ("tp", "b"): "missing_var", ("tp", "c"): "missing_var"}
    with pytest.raises(ValueError):
        audit.require_axis(obs, spine)
    audit.require_subset(obs, spine)


@pytest.mark.parametrize("down", [False, True])
def test_regrid_of_linear_field_is_exact(spark, down):
    g = grid(spark, down=down)
    field = g.withColumn("value", 3 * F.col("latitude") - 2 * F.col("longitude") + 1)
    sign = -1 if down else 1
    points = spark.createDataFrame([(1, 40.0 + sign * 0.3, 278.3), (2, 40.0 + sign * 1.5, 279.0), (3, 40.0, 278.0), (4, 50.0, 278.3), (5, 40.0 + sign * 0.3, 280.0)], "dst_cell long, latitude double, longitude double")
    w = regrid.bilinear_weights(g, points)
    assert {r[0]: round(r[1], 9) for r in w.groupBy("dst_cell").agg(F.sum("w")).collect()} == {1: 1, 2: 1, 3: 1}
    got = {r.cell_id: r.value for r in regrid.regrid(field, w).collect()}
    for p in points.where("dst_cell <= 3").collect():
        assert abs(got[p.dst_cell] - (3 * p.latitude - 2 * p.longitude + 1)) < 1e-6
    hole = field.withColumn("value", F.when((F.col("y") == 1) & (F.col("x") == 1), None).otherwise(F.col("value")))
    assert {r.cell_id: r.value is None for r in regrid.regrid(hole, w).collect()} == {1: True, 2: False, 3: True}


def test_unwrap_and_calendar(spark):
    g = spark.createDataFrame([(0, 0, 358.0), (0, 1, 359.5), (0, 2, 1.0), (0, 3, 2.5), (1, 0, 10.0), (1, 1, 190.0), (1, 2, 10.0)], "y int, x int, longitude double")
    got = [r.lon_unwrapped for r in align.unwrap(g).orderBy("y", "x").collect()]
    assert got == [358.0, 359.5, 361.0, 362.5, 10.0, 190.0, 10.0]
    noleap = spark.createDataFrame([(2024, 2, 28, 23, 1, 1.0), (2024, 3, 1, 0, 1, 2.0)], "year int, month int, day int, hour int, cell_id long, value double")
    out = align.standard_calendar(noleap, align.axis(spark, "2024-02-28 23:00:00", "2024-03-01 00:00:00"), "cell_id")
    assert out.count() == 26 and out.where("value is null").count() == 24


def test_runs(spark):
    df = spark.createDataFrame([(i,) for i in (3, 4, 5, 9, 11, 12)], "idx long")
    assert sorted(tuple(r) for r in align.runs(df, "idx").collect()) == [(0, 3, 3, 6), (3, 4, 9, 10), (4, 6, 11, 13)]


def test_registry_errors(spark):
    cols = "target_var string, family string, level string, run_type string, include_in_cli string"
    ok = spark.createDataFrame([(" a", "f", "l", "anl", "Yes"), ("b", "f", "l", "anl", "0")], cols)
    assert [r.include_in_cli for r in registry.load(ok).orderBy("target_var").collect()] == [True, False]
    with pytest.raises(ValueError, match="Repeated"):
        registry.load(ok.unionByName(ok))
    with pytest.raises(ValueError, match="Blank"):
        registry.load(spark.createDataFrame([(" ", "f", "l", "anl", "1")], cols))
    with pytest.raises(ValueError, match="missing"):
        registry.load(ok.drop("family"))
    with pytest.raises(ValueError, match="No registry row"):
        registry.resolve(spark.createDataFrame([("z", "f", "l", "anl")], "target_var string, family string, level string, run_type string"), ok)
    with pytest.raises(ValueError, match="Ambiguous"):
        r = spark.createDataFrame([("a", "", "x"), ("a", "any", "y")], "var_name string, grp string, source_var string")
        registry.require_unambiguous(registry.group_lookup(spark.createDataFrame([("a", "sl")], "var_name string, grp string"), r))
    with pytest.raises(Exception, match="Different units"):
        registry.consistent(spark.createDataFrame([("a", "m"), ("a", "K")], "k string, units string"), "k", "units").collect()


def test_text_sources(spark, tmp_path):
    (tmp_path / "v.txt").write_text("Variable: A\n  description: first\n  long_name: Long A, hourly\n  stagger: \n  units: mm\n\nVariable: B\n  description: \n  long_name: Bee\n  stagger: X\n  units: m s-1\n")
    got = {r["var"]: (r.long_name, r.units, r.description) for r in tables.description_blocks(spark, str(tmp_path / "v.txt")).collect()}
    assert got == {"A": ("Long A, hourly", "mm", "first"), "B": ("Bee", "m s-1", "")}
    (tmp_path / "m.txt").write_text("file\nshortName name level typeOfLevel\nclwmr        Cloud mixing ratio  1            hybrid      \n")
    assert [tuple(r) for r in tables.message_list(spark, str(tmp_path / "m.txt")).collect()] == [("clwmr", "Cloud mixing ratio", 1, "hybrid")]
    (tmp_path / "c.csv").write_text("index,source_id,experiment_id,variant,realization,ncml_timerange,sim_start_year,sim_end_year,dest_subdir\n0,E,ev,r1,v1,197901010000-202012312300,1979,1980,E/ev\n")
    c = tables.catalog_csv(spark, str(tmp_path / "c.csv"))
    assert c.first().sim_end_year == 1980 and windows.time_windows(c, "month").count() == 24
    with pytest.raises(ValueError, match="mode"):
        windows.time_windows(c, "week")
    with pytest.raises(ValueError, match="None of"):
        tables.column_of(c, "latitude", "lat")


def test_percentiles_and_extent(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(101)], "var string, value double")
    got = {r.percentile: r.value for r in stats.percentiles(df, "var").collect()}
    assert got[1] == 1 and got[50] == 50 and got[100] == 100
    exact, near = stats.spacing(grid(spark, 30, 30)).first(), stats.spacing(grid(spark, 30, 30), approximate=True).first()
    assert all(abs(a - b) < 0.03 * a for a, b in zip(exact, near, strict=True))
    g = grid(spark, 5, 5)
    assert stats.block_mean(g.withColumn("f", F.col("x").cast("double")), 2, "f").count() == 4


def test_nearest_weights_on_sparse_mesh(spark):
    import math
    import random

    from gridloom.operators.mesh import nearest_weights

    rng = random.Random(4)
    nodes = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(60)] + [(100, 0.0, 359.9), (101, 89.0, 10.0), (102, 88.5, 185.0)]
    points = [(i, rng.uniform(-90, 90), rng.uniform(0, 360)) for i in range(80)] + [(200, 0.0, 0.1), (201, 89.5, 190.0), (202, 90.0, 0.0), (203, -90.0, 5.0), (204, 10.0, -180.0)]

    def far(p, n):
        a, b, c = math.radians(p[1]), math.radians(n[1]), math.radians(n[2] - p[2])
        return math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(c / 2) ** 2

    mesh = spark.createDataFrame(nodes, "cell_id long, latitude double, longitude double")
    got = nearest_weights(mesh, spark.createDataFrame(points, "dst_cell long, latitude double, longitude double"), 1.0).collect()
    want = {p[0]: min(nodes, key=lambda n: far(p, n))[0] for p in points}
    assert len(got) == len(points) and {r["dst_cell"]: r["src_cell"] for r in got} == want


def test_discover_reads_attributes_once(spark):
    from gridloom.operators import registry

    row = ("r", "f", "l", "s", "anl", '{"units": "m", "_ARRAY_DIMENSIONS": ["a", "b"], "n": 1.0}', [1, 2], [1, 1], "<f4")
    x = registry.discover(spark.createDataFrame([row], "root string, family string, level string, source_var string, run_type string, attrs string, shape array<int>, chunks array<int>, dtype string"))
    r = x.first()
    assert (r["units"], r["dims"], r["attrs_json"], r["target_var"]) == ("m", "a,b", '{"n":"1.0","units":"m"}', "s")
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and plan.count("from_json(MapType") <= 1
