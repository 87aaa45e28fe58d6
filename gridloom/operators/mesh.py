"""Weights from meshes without even steps: quads of curvilinear grids, nearest nodes by a hierarchical cell index."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.weather import haversine_km

#: Newton steps of the inverse bilinear map; each doubles the digits, from a quad's middle on.
STEPS = 8
EDGE, FIT = 1e-9, 1e-7
#: Degrees of the smallest and largest regions that have a frame of their own.
REGION = 0.5, 90.0
#: Side of a bin in mean quads, and what places in mean quads can be off by.
SIDE, ROOM = 2.0, 1e-6
#: Nodes that may share a cube with one, on average; the finest cubes have edge 2^-FINEST.
CROWD, FINEST = 8, 18


def _turn(lon: Column, base: Column) -> Column:
    """Degrees east of a base, from -180 to 180."""
    return F.pmod(lon - base + 180.0, F.lit(360.0)) - 180.0


def quads(source: DataFrame) -> DataFrame:
    """(qy, qx, k0, k1, k2, k3): cells of a mesh (cell_id, y, x, latitude, longitude) between nodes (y, x), (y, x + 1),
    (y + 1, x) and (y + 1, x + 1), each a struct; quads that lack a node or a coordinate are none.

    Each node goes to the four quads it can be a corner of, so no row or column of the mesh comes together in a task.
    """
    node = F.struct("cell_id", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    at = F.array(*(F.struct((F.col("y") - a).alias("qy"), (F.col("x") - b).alias("qx"), F.lit(2 * a + b).alias("k")) for a in (0, 1) for b in (0, 1)))
    x = source.where("latitude is not null and longitude is not null").select(node.alias("node"), F.explode(at).alias("at"))
    corner = lambda k: F.min(F.when(F.col("at.k") == k, F.col("node"))).alias(f"k{k}")
    return x.groupBy("at.qy", "at.qx").agg(*map(corner, range(4))).dropna()


def _inverse() -> Column:
    """Struct (u, v) of the point (px, py) in the quad of sides (x1, y1), (x2, y2) and twist (x3, y3); null outside of it."""
    x, y = ({k: F.col(f"{c}{k}") for k in (1, 2, 3)} for c in "xy")
    off = lambda a, of, p: a.u * of[1] + a.v * of[2] + a.u * a.v * of[3] - F.col(p)

    def step(a: Column, _: Column) -> Column:
        xu, xv, yu, yv = x[1] + a.v * x[3], x[2] + a.u * x[3], y[1] + a.v * y[3], y[2] + a.u * y[3]
        det, dx, dy = F.nullif(xu * yv - xv * yu, F.lit(0.0)), off(a, x, "px"), off(a, y, "py")
        return F.struct((a.u - (dx * yv - dy * xv) / det).alias("u"), (a.v - (dy * xu - dx * yu) / det).alias("v"))

    def inside(a: Column) -> Column:
        return F.when(a.u.between(-EDGE, 1 + EDGE) & a.v.between(-EDGE, 1 + EDGE) & (F.abs(off(a, x, "px")) + F.abs(off(a, y, "py")) < FIT), a)

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(F.lit(0.5).alias("u"), F.lit(0.5).alias("v")), step, inside)


def _in_frame(x: Column, y: Column) -> tuple[Column, Column]:
    """Place (s, t) in mean quads of a region's frame (ax, ay, cx, cy) of what lies x and y degrees from its corner."""
    det = F.col("ax") * F.col("cy") - F.col("ay") * F.col("cx")
    return (x * F.col("cy") - y * F.col("cx")) / det, (y * F.col("ax") - x * F.col("ay")) / det


def _frames(q: DataFrame) -> DataFrame:
    """(bx, by, ax, ay, cx, cy): the mean edges of the quads of each region along both axes of the mesh; where these
    nearly cancel or are parallel, the mean width and height."""
    f = q.groupBy("bx", "by").agg(
        *(F.avg(c).alias(n) for c, n in (("x1", "ax"), ("y1", "ay"), ("x2", "cx"), ("y2", "cy"))), F.avg(F.col("xh") - F.col("xl")).alias("w"), F.avg(F.col("yh") - F.col("yl")).alias("h"))
    a, c = F.hypot("ax", "ay"), F.hypot("cx", "cy")
    flat = F.abs(F.col("ax") * F.col("cy") - F.col("ay") * F.col("cx")) <= 1e-3 * F.greatest(a * c, 1e-6 * F.col("w") * F.col("h"))
    plain = {"ax": F.col("w"), "ay": F.lit(0.0), "cx": F.lit(0.0), "cy": F.col("h")}
    return f.select("bx", "by", *(F.when(flat, plain[n]).otherwise(F.col(n)).alias(n) for n in plain))


def curvilinear_candidates(source: DataFrame, points: DataFrame, bin_degrees: float = 1.0) -> DataFrame:
    """Pairs of points (dst_cell, lat, lon) and quads of the mesh that can hold them.

    Quads and points are dealt to regions of bin_degrees, and within these to bins of SIDE mean quads, along the mean edges
    of the region's quads. So thin and skewed quads, whose boxes of latitudes and longitudes overlap, still meet only
    points near them, and work is in proportion to both tables. Quads larger than the mean go to bins 2, 4, ... times as
    large, so each has a few bins; points look in all sizes that their region has. Frames, one a region, are broadcast.
    """
    size = min(max(bin_degrees, REGION[0]), REGION[1])
    across = int(360 // size)
    wide = 360.0 / across
    q = quads(source)
    for k in (1, 2, 3):
        q = q.withColumns({f"x{k}": _turn(F.col(f"k{k}.lon"), F.col("k0.lon")), f"y{k}": F.col(f"k{k}.lat") - F.col("k0.lat")})
    low, high = ({c: f(F.lit(0.0), *(F.col(f"{c}{k}") for k in (1, 2, 3))) for c in "xy"} for f in (F.least, F.greatest))
    q = q.withColumns({"xl": low["x"] - EDGE, "xh": high["x"] + EDGE, "yl": low["y"] - EDGE, "yh": high["y"] + EDGE})
    west, south = F.pmod("k0.lon", F.lit(360.0)), F.col("k0.lat")
    q = q.withColumn("bx", F.explode(F.array_distinct(F.transform(F.sequence(F.floor((west + F.col("xl")) / wide), F.floor((west + F.col("xh")) / wide)), lambda b: F.pmod(b, F.lit(across).cast("long"))))))
    q = q.withColumn("by", F.explode(F.sequence(F.floor((south + F.col("yl")) / size), F.floor((south + F.col("yh")) / size))))
    frames = F.broadcast(_frames(q))  # bounded by REGION
    q = q.join(frames, ["bx", "by"])
    x, y = F.pmod(F.col("k0.lon") + F.col("xh") - F.col("bx") * wide, F.lit(360.0)) - F.col("xh"), south - F.col("by") * size
    ends = [_in_frame(x, y), *(_in_frame(x + F.col(f"x{k}"), y + F.col(f"y{k}")) for k in (1, 2, 3))]
    for c, of in zip("st", zip(*ends, strict=True), strict=True):
        q = q.withColumns({f"{c}l": F.least(*of), f"{c}h": F.greatest(*of)})
        room = ROOM * (1 + F.col(f"{c}h") - F.col(f"{c}l"))
        q = q.withColumns({f"{c}l": F.col(f"{c}l") - room, f"{c}h": F.col(f"{c}h") + room})
    q = q.withColumn("k", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col("sh") - F.col("sl"), F.col("th") - F.col("tl")) / SIDE)).cast("int")))
    bin_of = lambda c: F.floor(F.col(c) / (SIDE * F.pow(F.lit(2.0), F.col("k"))))
    sizes = F.broadcast(q.groupBy("bx", "by").agg(F.collect_set("k").alias("ks")))  # as many as frames
    q = q.withColumns({"x3": F.col("x3") - F.col("x1") - F.col("x2"), "y3": F.col("y3") - F.col("y1") - F.col("y2")}).drop("ax", "ay", "cx", "cy")
    for c in "st":
        q = q.withColumn(f"{c}b", F.explode(F.sequence(bin_of(f"{c}l"), bin_of(f"{c}h"))))
    p = points.where("latitude is not null and longitude is not null").select(
        "dst_cell", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"),
        F.least(F.floor(F.pmod("longitude", F.lit(360.0)) / wide), F.lit(across - 1)).cast("long").alias("bx"), F.floor(F.col("latitude") / size).alias("by"),
    )
    s, t = _in_frame(F.pmod("lon", F.lit(360.0)) - F.col("bx") * wide, F.col("lat") - F.col("by") * size)
    p = p.join(frames, ["bx", "by"]).join(sizes, ["bx", "by"]).select("dst_cell", "lat", "lon", "bx", "by", s.alias("s"), t.alias("t"), F.explode("ks").alias("k"))
    m = p.withColumns({"sb": bin_of("s"), "tb": bin_of("t")}).join(q, ["bx", "by", "k", "sb", "tb"])
    m = m.where(F.col("s").between(F.col("sl"), F.col("sh")) & F.col("t").between(F.col("tl"), F.col("th")))
    m = m.withColumns({"px": _turn(F.col("lon"), F.col("k0.lon")), "py": F.col("lat") - F.col("k0.lat")})
    return m.where(F.col("px").between(F.col("xl"), F.col("xh")) & F.col("py").between(F.col("yl"), F.col("yh")))


def curvilinear_weights(source: DataFrame, points: DataFrame, bin_degrees: float = 1.0) -> DataFrame:
    """(dst_cell, src_cell, w): the four corners of the mesh's quad round each point (dst_cell, latitude, longitude).

    source: any mesh with rows and columns (cell_id, y, x, latitude, longitude), skewed, rotated or over the date line; its
    quads are those of straight edges between longitudes and latitudes, so none should hold a pole. Quads and points meet in
    bins laid along the quads' edges; bin_degrees is the size of regions where quads are about alike, and a wrong one only
    costs time. A point inside is one whose inverse bilinear map (Newton steps from the quad's middle) lies within 0 to 1.
    Points on an edge take the quad of the least row and column; those in no quad, and those without coordinates, get no rows.
    """
    m = curvilinear_candidates(source, points, bin_degrees)
    m = m.withColumn("uv", _inverse()).where("uv is not null")
    best = F.min_by(F.struct("uv.u", "uv.v", *(F.col(f"k{k}.cell_id").alias(f"c{k}") for k in range(4))), F.struct("qy", "qx"))
    m = m.groupBy("dst_cell").agg(best.alias("q"))
    u, v = (F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(F.col(f"q.{c}"), 12))) for c in "uv")
    corners = F.array(*(F.struct(F.col(f"q.c{2 * a + b}").alias("src_cell"), ((v if a else 1 - v) * (u if b else 1 - u)).alias("w")) for a in (0, 1) for b in (0, 1)))
    return m.select("dst_cell", F.explode(corners).alias("c")).select("dst_cell", "c.src_cell", "c.w")


def _on_sphere(df: DataFrame, *rest: str) -> DataFrame:
    lat, lon = F.radians("latitude"), F.radians("longitude")
    at = [(F.cos(lat) * F.cos(lon)).alias("x"), (F.cos(lat) * F.sin(lon)).alias("y"), F.sin(lat).alias("z")]
    return df.where("latitude is not null and longitude is not null").select(*rest, "latitude", "longitude", *at)


def _cell(level: int) -> Column:
    """The cube of edge 2^-level that holds a point of the unit sphere, 21 bits an axis."""
    axis = lambda c: (F.floor(F.col(c) * (1 << level)) + (1 << 19)).cast("long")
    return F.shiftleft(axis("x"), 42).bitwiseOR(F.shiftleft(axis("y"), 21)).bitwiseOR(axis("z"))


def nearest_candidates(source: DataFrame, points: DataFrame, level: int, step: int = 2) -> DataFrame:
    """(dst_cell, latitude, longitude, src_cell, slat, slon): nodes that can be nearest to each point, found from the whole
    sphere down to cubes of edge 2^-level.

    A point begins with the few cubes of edge 1 that hold nodes. At each level its cubes are replaced by those within
    them, and the ones stay whose box of nodes begins no farther off than the nearest of the boxes' ends or of one node in
    each. So far points meet the few boxes at the mesh's edge, near points those around them, and none meets all nodes.
    """
    nodes = _on_sphere(source.withColumnRenamed("cell_id", "src_cell"), "src_cell")
    x = _on_sphere(points, "dst_cell").withColumnsRenamed({c: f"p{c}" for c in "xyz"})
    levels = [*range(0, level, step), level]
    for above, at in zip([None, *levels], levels, strict=False):
        boxes = nodes.groupBy(_cell(at).alias("cell"), (_cell(above) if above is not None else F.lit(0)).alias("up")).agg(
            *(f(c).alias(f"{c}{s}") for c in "xyz" for s, f in (("l", F.min), ("h", F.max))), *(F.min_by(c, "src_cell").alias(f"{c}1") for c in "xyz"))
        if above is None:
            x = x.join(F.broadcast(boxes), how="cross")  # at most 26 cubes of edge 1 touch the sphere
        else:
            x = x.withColumnRenamed("cell", "up").join(boxes, "up")
        sq = lambda c: c * c
        nearest = sum(sq(F.greatest(F.col(f"{c}l") - F.col(f"p{c}"), F.lit(0.0), F.col(f"p{c}") - F.col(f"{c}h"))) for c in "xyz")
        farthest = sum(sq(F.greatest(F.abs(F.col(f"p{c}") - F.col(f"{c}l")), F.abs(F.col(f"p{c}") - F.col(f"{c}h")))) for c in "xyz")
        known = sum(sq(F.col(f"p{c}") - F.col(f"{c}1")) for c in "xyz")
        most = F.min(F.sqrt(F.least(farthest, known))).over(Window.partitionBy("dst_cell", "latitude", "longitude"))
        x = x.withColumns({"near": F.sqrt(nearest), "most": most}).where(F.col("near") <= F.col("most") + 1e-8)
        x = x.select("dst_cell", "latitude", "longitude", "px", "py", "pz", "cell")
    leaf = nodes.select("src_cell", F.col("latitude").alias("slat"), F.col("longitude").alias("slon"), _cell(level).alias("cell"))
    return x.join(leaf, "cell").select("dst_cell", "latitude", "longitude", "src_cell", "slat", "slon")


def level_of(source: DataFrame, first: int) -> int:
    """The first level, from a given one on, in whose cubes a node meets at most CROWD nodes on average (itself included)."""
    at = F.array(*(F.struct(F.lit(k).alias("level"), _cell(k).alias("cell")) for k in range(first, FINEST + 1)))
    n = _on_sphere(source).select(F.explode(at).alias("at")).groupBy("at.level", "at.cell").agg(F.count("*").cast("double").alias("n"))
    crowd = {r["level"]: r["crowd"] for r in n.groupBy("level").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("crowd")).collect()}  # a row a level
    return next((k for k in sorted(crowd) if crowd[k] <= CROWD), max(crowd, default=first))


def nearest_weights(source: DataFrame, points: DataFrame, bin_degrees: float) -> DataFrame:
    """(dst_cell, src_cell, w = 1): the nearest source node of any mesh (ties: the smaller cell) for each point.

    bin_degrees: about the distance between nodes, where cubes begin; how much finer they get is counted from the nodes, so
    meshes that are denser, or dense along one axis only, don't compare more nodes a point. Nodes at one place are one, that
    of the smallest cell. Points and nodes without coordinates are left out; without nodes there are no rows. One plan
    whatever the mesh, of a round for each two levels.
    """
    source = source.where("latitude is not null and longitude is not null").groupBy("latitude", "longitude").agg(F.min("cell_id").alias("cell_id"))
    level = level_of(source, max(1, min(FINEST, math.ceil(math.log2(1 / math.radians(bin_degrees))))))
    x = nearest_candidates(source, points, level)
    d = haversine_km(F.col("latitude"), F.col("longitude"), F.col("slat"), F.col("slon"))
    best = x.groupBy("dst_cell").agg(F.min(F.struct(d.alias("d"), "src_cell")).alias("best"))
    return best.select("dst_cell", "best.src_cell", F.lit(1.0).alias("w"))


def kept_weights(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The weights written at a path, made the first time only. A write that stopped halfway is made again."""
    try:
        spark.read.text(f"{path}/_SUCCESS").schema  # noqa: B018 - the path is looked up here
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
