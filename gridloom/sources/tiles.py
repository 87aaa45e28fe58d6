"""Files laid out in tiles of time and space, so that a box of some days reads few of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ranges of a box's tiles that become predicates; beyond these, the nearest ones are joined (exact filters follow).
MOST_RANGES = 64


def hilbert(y: Column, x: Column, bits: int = 12) -> Column:
    """Place of a cell (y, x; each below 2^bits, none negative) on the Hilbert curve: neighbours on it are neighbours."""
    side = 1 << bits
    sizes = F.array(*(F.lit(1 << b).cast("long") for b in reversed(range(bits))))
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(a: Column, s: Column) -> Column:
        right, up = a["x"].bitwiseAND(s) > 0, a["y"].bitwiseAND(s) > 0
        quarter = F.when(right & up, 2).when(right, 3).when(up, 1).otherwise(0)
        turned = lambda c: F.when(right, F.lit(side - 1) - a[c]).otherwise(a[c])
        nx, ny = F.when(up, a["x"]).otherwise(turned("y")), F.when(up, a["y"]).otherwise(turned("x"))
        return F.struct(nx.alias("x"), ny.alias("y"), (a["d"] + s * s * quarter).alias("d"))

    return F.aggregate(sizes, start, step, lambda a: a["d"])


def tile_of(y: Column, x: Column, block: int) -> Column:
    return hilbert(F.floor(y / block), F.floor(x / block))


def write_tiles(df: DataFrame, path: str, block: int = 64, hours: int = 24, files: int | None = None) -> None:
    """Write rows with time, y and x by (span, tile): spans of hours since 1970, and Hilbert places of block x block cells.

    Rows are dealt by range, so a file holds neighbouring tiles of a span and its statistics bound them; the cell's hash
    is the last part of the range, so that a tile of very many rows is spread over files. files: how many, else the
    session's number of shuffle partitions.
    """
    x = df.withColumns({"span": F.floor(F.unix_seconds("time") / (hours * 3600)), "tile": tile_of(F.col("y"), F.col("x"), block)})
    keys = ["span", "tile", F.xxhash64("y", "x", "time")]
    dealt = x.repartitionByRange(files, *keys) if files else x.repartitionByRange(*keys)
    dealt.sortWithinPartitions("span", "tile", "time", "y", "x").write.parquet(path)


def _ranges(tiles: list[int], most: int) -> list[tuple[int, int]]:
    """Ranges that hold all tiles, at most so many: those with the smallest gaps between them are joined."""
    tiles = sorted(tiles)
    gaps = sorted((b - a for a, b in zip(tiles, tiles[1:], strict=False)), reverse=True)
    least = max(1, gaps[most - 1]) if len(gaps) >= most else 1
    out: list[list[int]] = []
    for t in tiles:
        if out and t - out[-1][1] <= least:
            out[-1][1] = t
        else:
            out.append([t, t])
    return [(a, b) for a, b in out]


def read_box(spark: SparkSession, path: str, start: str, end: str, y: tuple[int, int], x: tuple[int, int], block: int = 64, hours: int = 24) -> DataFrame:
    """Rows of a box (y and x from, to, both included) between two times (included) of what write_tiles wrote so.

    The box's tiles are counted off (its area over a block's) and become ranges of the curve in predicates that reach the scan.
    """
    ys, xs = (spark.range(a // block, b // block + 1) for a, b in (y, x))
    own = ys.select(F.col("id").alias("y")).join(xs.select(F.col("id").alias("x")))
    tiles = [r[0] for r in own.select(hilbert(F.col("y"), F.col("x"))).collect()]
    within = F.lit(False)
    for a, b in _ranges(tiles, MOST_RANGES):
        within = within | F.col("tile").between(a, b)
    times = [F.lit(t).cast("timestamp") for t in (start, end)]
    a, b = spark.range(1).select(*(F.floor(F.unix_seconds(t) / (hours * 3600)) for t in times)).first()
    rows = spark.read.parquet(path).where(F.col("span").between(a, b) & within)
    return rows.where(F.col("time").between(*times) & F.col("y").between(*y) & F.col("x").between(*x)).drop("span", "tile")
