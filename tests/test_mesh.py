"""Weights of curvilinear meshes and of nearest nodes against plain Python."""

import math
import random

from pyspark.sql import functions as F

from gridloom.operators import mesh, regrid

POINTS = "dst_cell long, latitude double, longitude double"


def skewed(y, x):
    """A curved, rotated grid that crosses the date line."""
    return 40 + 0.9 * y + 0.25 * x + 0.01 * x * y, (176 + 1.1 * x - 0.3 * y + 0.008 * y * y + 180) % 360 - 180


def grid_of(spark, ny=12, nx=14, gone=()):
    rows = [(y * 100 + x, y, x, *map(float, skewed(y, x))) for y in range(ny) for x in range(nx) if (y, x) not in gone]
    return spark.createDataFrame([*rows, (9999, 50, 50, None, 1.0)], "cell_id long, y int, x int, latitude double, longitude double")


def inverse(quad, lat, lon):
    """(u, v) of a point in a quad by bisection of both in turn, or None outside."""
    turn = lambda a: (a - quad[0][1] + 180) % 360 - 180
    corners = [(c[0], turn(c[1])) for c in quad]
    p = (lat, turn(lon))
    at = lambda u, v: [c0 * (1 - u) * (1 - v) + c1 * u * (1 - v) + c2 * (1 - u) * v + c3 * u * v for c0, c1, c2, c3 in zip(*corners, strict=True)]
    u = v = 0.5
    for _ in range(60):
        fu, fv = at(u + 1e-6, v), at(u, v + 1e-6)
        f = at(u, v)
        j = [[(fu[i] - f[i]) / 1e-6 for i in (0, 1)], [(fv[i] - f[i]) / 1e-6 for i in (0, 1)]]
        det = j[0][0] * j[1][1] - j[0][1] * j[1][0]
        r = [p[0] - f[0], p[1] - f[1]]
        u, v = u + (r[0] * j[1][1] - r[1] * j[1][0]) / det, v + (r[1] * j[0][0] - r[0] * j[0][1]) / det
    return (u, v) if -1e-9 <= u <= 1 + 1e-9 and -1e-9 <= v <= 1 + 1e-9 else None


def test_curvilinear_weights(spark):
    rng = random.Random(2)
    gone = {(5, 5)}
    g = grid_of(spark, gone=gone)
    points = []
    for i in range(300):
        lat, lon = skewed(rng.uniform(-2, 13), rng.uniform(-2, 15))
        points.append((i, lat, lon if i % 2 else lon % 360))
    points += [(900, *map(float, skewed(3, 4))), (901, -70.0, 20.0), (902, None, 3.0)]
    got = {}
    for r in mesh.curvilinear_weights(g, spark.createDataFrame(points, POINTS), 2.0).collect():
        got.setdefault(r["dst_cell"], {})[r["src_cell"]] = r["w"]
    places = [(y, x) for y in range(11) for x in range(13) if not {(y, x), (y, x + 1), (y + 1, x), (y + 1, x + 1)} & gone]
    seen = 0
    for i, lat, lon in points:
        if lat is None:
            assert i not in got
            continue
        want = None
        for y, x in places:
            quad = [skewed(y + a, x + b) for a in (0, 1) for b in (0, 1)]
            if abs(quad[0][0] - lat) < 4 and (uv := inverse(quad, lat, lon)):
                u, v = uv
                want = {(y + a) * 100 + x + b: (v if a else 1 - v) * (u if b else 1 - u) for a in (0, 1) for b in (0, 1)}
                break
        assert (i in got) == (want is not None), i
        if want:
            seen += 1
            assert got[i].keys() == want.keys() and all(abs(got[i][k] - w) < 1e-6 for k, w in want.items())
    assert 150 < seen < 300 and max(got[900].values()) == 1.0


def test_linear_fields_are_exact_on_a_skewed_mesh(spark):
    g = grid_of(spark).where("latitude is not null")
    east = F.pmod("longitude", F.lit(360.0))
    field = g.select("cell_id", (3 * F.col("latitude") - 2 * east + 1).alias("value"))
    rng = random.Random(6)
    points = [(i, *skewed(rng.uniform(0.5, 10.5), rng.uniform(0.5, 12.5))) for i in range(200)]
    got = {r["cell_id"]: r["value"] for r in regrid.regrid(field, mesh.curvilinear_weights(g, spark.createDataFrame(points, POINTS))).collect()}
    assert len(got) == 200 and all(abs(got[i] - (3 * lat - 2 * (lon % 360) + 1)) < 1e-6 for i, lat, lon in points)


def far(a, b):
    lat, to, turn = math.radians(a[1]), math.radians(b[1]), math.radians(b[2] - a[2])
    return math.sin((to - lat) / 2) ** 2 + math.cos(lat) * math.cos(to) * math.sin(turn / 2) ** 2


def test_far_points_meet_few_nodes_of_a_regional_mesh(spark):
    compared = {}
    for n in (20, 40):
        nodes = [(y * n + x, 40 + 8 * y / n, -80 + 10 * x / n) for y in range(n) for x in range(n)]
        rng = random.Random(8)
        points = [(i, math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for i in range(150)] + [(1000 + i, rng.uniform(40, 48), rng.uniform(-80, -70)) for i in range(150)]
        source, at = spark.createDataFrame(nodes, "cell_id long, latitude double, longitude double"), spark.createDataFrame(points, POINTS)
        got = {r["dst_cell"]: r["src_cell"] for r in mesh.nearest_weights(source, at, 10 / n).collect()}
        for p in points:
            best = min(far(p, m) for m in nodes)
            assert far(p, nodes[got[p[0]]]) <= best + 1e-15
        level = math.ceil(math.log2(1 / math.radians(10 / n)))
        compared[n] = mesh.nearest_candidates(source, at, level).count() / len(points)
    assert compared[40] < 30 and compared[40] < 2.5 * compared[20]  # of 1,600 nodes; four times the nodes aren't four times the work
    empty = mesh.nearest_weights(source.limit(0), at, 1.0)
    assert empty.count() == 0


def test_weights_are_kept(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3).withColumnRenamed("id", "dst_cell")
    for _ in range(3):
        assert mesh.kept_weights(spark, str(tmp_path / "w"), make).count() == 3
    assert made == [1]
    (tmp_path / "w" / "_SUCCESS").unlink()  # a write that stopped halfway
    assert mesh.kept_weights(spark, str(tmp_path / "w"), make).count() == 3 and made == [1, 1]


def thin(spark, n, columns=6):
    """A mesh of columns 0.45 degrees apart whose rows, skewed, are ever denser within half a degree."""
    rows = [(y * columns + x, y, x, 40 + 0.5 * y / n + 0.01 * x, 276 + 0.45 * x) for y in range(n) for x in range(columns)]
    g = spark.createDataFrame(rows, "cell_id long, y int, x int, latitude double, longitude double")
    return g, g.select(F.col("cell_id").alias("dst_cell"), (F.col("latitude") + 0.17 / n).alias("latitude"), (F.col("longitude") + 0.2).alias("longitude"))


def test_nodes_on_dense_rows_are_compared_in_proportion(spark):
    nodes = {}
    for n in (100, 800):
        g, at = thin(spark, n)
        nodes[n] = mesh.nearest_candidates(g, at, mesh.level_of(g, 6)).count() / (6 * n)
    assert max(nodes.values()) < 4 * mesh.CROWD  # nodes of a few cubes, of 4,800
    twice = g.unionByName(g.withColumn("cell_id", F.col("cell_id") + 10000))
    assert mesh.nearest_weights(twice, at, 1.0).exceptAll(mesh.nearest_weights(g, at, 0.01)).count() == 0


def test_quads_on_dense_rows_are_compared_in_proportion(spark):
    quads = {}
    for n in (100, 800):
        g, at = thin(spark, n)
        quads[n] = mesh.curvilinear_candidates(g, at).count() / (6 * n)
        w = mesh.curvilinear_weights(g, at).groupBy("dst_cell").agg(F.collect_set("src_cell").alias("s"), F.sum("w").alias("w"))
        got = {r["dst_cell"]: r for r in w.collect()}
        assert len(got) > 4.5 * n and all(abs(r["w"] - 1) < 1e-9 and len(r["s"]) == 4 for r in got.values())
    assert quads[800] < 3 and quads[800] < 1.5 * quads[100]


def test_large_quads_among_small_ones(spark):
    """Fine rows, then one row far away: quads of very different sizes and turned edges."""
    at = [*(40 + 0.001 * k for k in range(40)), 55.0, 54.0]
    rows = [(y * 3 + x, y, x, lat + 0.1 * x, (359.0 + 1.5 * x) % 360) for y, lat in enumerate(at) for x in range(3)]
    g = spark.createDataFrame(rows, "cell_id long, y int, x int, latitude double, longitude double")
    rng = random.Random(4)
    points = [(i, rng.uniform(40.2, 40.22) if i % 2 else rng.uniform(40.3, 54), (359.2 + rng.uniform(0, 2.5)) % 360) for i in range(200)]
    got = {}
    for r in mesh.curvilinear_weights(g, spark.createDataFrame(points, POINTS), 0.7).collect():
        got.setdefault(r["dst_cell"], {})[r["src_cell"]] = r["w"]
    for i, lat, lon in points:
        found = []
        for y in range(41):
            for x in range(2):
                quad = [(at[y + a] + 0.1 * (x + b), (359.0 + 1.5 * (x + b)) % 360) for a in (0, 1) for b in (0, 1)]
                if uv := inverse(quad, lat, lon):
                    found.append(((y, x), uv))
        assert (i in got) == bool(found), i
        if found:
            (y, x), (u, v) = found[0]
            want = {(y + a) * 3 + x + b: (v if a else 1 - v) * (u if b else 1 - u) for a in (0, 1) for b in (0, 1)}
            assert got[i].keys() == want.keys() and all(abs(got[i][k] - w) < 1e-6 for k, w in want.items())
