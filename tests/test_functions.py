import math

import pytest
from pyspark.sql import functions as F

from gridloom.functions import names, units, weather
from gridloom.functions.derived import derive_when_complete


def one(spark, col, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(col.alias("x")).first()["x"]


def test_direction(spark):
    d = weather.wind_direction(F.col("u"), F.col("v"))
    assert one(spark, d, u=0.0, v=0.0) == 0
    assert one(spark, weather.wind_direction(F.col("u"), F.col("v"), None), u=0.0, v=0.0) == 270
    assert one(spark, d, u=0.0, v=-5.0) == 0 and one(spark, d, u=-5.0, v=0.0) == 90
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (None, 0.0)], "u double, v double")
    assert all(r[0] is None for r in df.select(d).collect())
    grid = spark.createDataFrame([(a / 2, b / 2) for a in range(-6, 7) for b in range(-6, 7)], "u double, v double")
    assert grid.where(~(d >= 0) | ~(d < 360)).count() == 0


def test_missing(spark):
    df = spark.createDataFrame([(-999.0,), (-99.0,), (-91.0,), (-90.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in df.select(weather.sentinels_to_null(F.col("x"))).collect()] == [None, None, None, -90.0, 3.0, None]
    assert [r[0] for r in df.select(weather.clip_low(F.col("x"), 0.0)).collect()] == [0, 0, 0, 0, 3.0, None]
    assert spark.range(1).select(weather.nan_to_null(F.lit(float("nan")))).first()[0] is None


def test_coordinates(spark):
    assert one(spark, weather.longitude_360(F.col("x")), x=-82.0) == 278
    assert one(spark, weather.longitude_180(F.col("x")), x=278.0) == -82
    assert abs(one(spark, weather.haversine_km(*(F.col(c) for c in "abcd")), a=0.0, b=0.0, c=0.0, d=1.0) - math.radians(1) * 6371.0088) < 1e-6
    x, y = weather.albers(F.col("lon"), F.col("lat"))
    assert abs(one(spark, x, lon=-96.0, lat=23.0)) < 1e-6 and abs(one(spark, y, lon=-96.0, lat=23.0)) < 1e-6
    assert one(spark, x, lon=-75.0, lat=40.0) > 1.7e6


@pytest.mark.parametrize(("raw", "want"), [("m/s", "m s**-1"), (" KG  m-2 ", "kg m**-2"), ("furlong", "furlong"), ("", ""), ("1", "kg kg**-1"), ("hpa", "hPa")])
def test_normal_units(spark, raw, want):
    assert one(spark, units.normal_units(F.col("u")), u=raw) == want


def test_convert(spark):
    df = spark.createDataFrame([("tp", 2.0, "m"), ("sp", 3.0, "hPa"), ("tp", 1.0, "kg m-2 s-1"), ("tp", 1.0, "kg m-2"), ("zz", 1.0, "m"), ("tp", 1.0, "")], "var string, value double, units string")
    got = units.convert(df).collect()
    assert [r.value for r in got] == [2000, 300, 3600, 1, 1, 1]
    assert [r.units for r in got] == ["kg m**-2", "Pa", "kg m**-2", "kg m**-2", "", "kg m**-2"] and got[4].long_name == "zz"
    bad = spark.createDataFrame([("tp", 2.0, "inch")], "var string, value double, units string")
    assert units.unconvertible(bad).count() == 1
    assert units.convert(bad, strict=False).first().value is None
    with pytest.raises(Exception, match="No factor"):
        units.convert(bad).collect()
    wide = units.stamped(df.where("value = 2").select(F.lit(1.0).alias("u10"), F.lit(3.0).alias("sp"), F.lit(2.0).alias("tp"), F.lit(5).alias("other")), {"sp": "hPa", "tp": ""})
    assert wide.schema["u10"].metadata == {"units": "m s**-1", "long_name": "10 m eastward wind", "_FillValue": "NaN", "missing_value": "NaN"} and not wide.schema["other"].metadata
    assert tuple(wide.first()) == (1.0, 300.0, 2.0, 5)
    with pytest.raises(Exception, match="No factor"):
        units.stamped(df.select(F.lit(3.0).alias("sp")), {"sp": "bar"}).collect()


def test_time_codes(spark):
    df = spark.createDataFrame([(60, "minutes since 2018-01-01"), (2, "hours since 2018-01-01 00:00:00"), (1_514_764_800_000_000_000, ""), (1_514_764_800_000_000_000, None)], "raw long, units string")
    got = [str(r[0]) for r in df.select(units.decode_time(F.col("raw"), F.col("units")).cast("string")).collect()]
    assert got == ["2018-01-01 01:00:00", "2018-01-01 02:00:00", "2018-01-01 00:00:00", "2018-01-01 00:00:00"]
    with pytest.raises(Exception, match="Unsupported time unit"):
        spark.createDataFrame([(1, "weeks since 2018-01-01")], "raw long, units string").select(units.decode_time(F.col("raw"), F.col("units"))).collect()
    assert one(spark, units.encode_time(F.col("t").cast("timestamp"), "hours", "2018-01-01"), t="2018-01-02 03:00:00") == 27


def test_names(spark):
    assert one(spark, names.clean_text(F.col("t")), t=" a   b\t") == "a b"
    assert one(spark, names.normal_level(F.col("t")), t="10m_Above_Ground") == "10m_above_ground"
    assert one(spark, names.normal_level(F.col("t")), t="0.1_sigma_layer") == "0.1_sigma_level"
    assert one(spark, names.list_items(F.col("t")), t=" a,b  a,, c") == ["a", "b", "c"]
    assert one(spark, names.dimensions(F.col("r"), F.col("t")), r=0, t="anl") == []
    stated = names.dimensions(F.col("r"), F.col("t"), F.col("a"))
    assert one(spark, stated, r=2, t="anl", a='{"_ARRAY_DIMENSIONS": ["lat", "lon"]}') == ["lat", "lon"] and one(spark, stated, r=2, t="anl", a='{"_ARRAY_DIMENSIONS": []}') == ["y", "x"]
    assert names.index_list("0-5,10, 7", 10) == [0, 1, 2, 3, 4, 5, 7, 10]
    with pytest.raises(ValueError, match="ends at 10"):
        names.index_list("9-12", 10)
    with pytest.raises(Exception, match="Neither"):
        one(spark, names.modes(F.col("t")), t="none")
    assert one(spark, names.time_of_name(F.col("p")), p="x/no-time") is None
    assert one(spark, names.hour_of_name(F.col("p")), p="a/t06z.grb") == 6 and one(spark, names.hour_of_name(F.col("p")), p="s.2019010107.pcp_01h") == 7


def test_derive_waits(spark):
    rows = [(f"2024-01-0{d} {h:02d}:00:00", 1, v, 3.0) for d in (1, 2) for h in range(4) for v in ("u10", "v10") if (d, h, v) != (2, 3, "v10")]
    df = spark.createDataFrame(rows, "t string, cell_id long, var string, value double").withColumn("time", F.to_timestamp("t")).drop("t")
    got = derive_when_complete(df, "si10", 4).select(F.dayofmonth("time")).distinct().collect()
    assert [r[0] for r in got] == [1]
