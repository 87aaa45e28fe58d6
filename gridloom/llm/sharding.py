"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one key are dealt out in blocks of so many.
REPEAT_BLOCK = 4096


def ring_owners(shards: int, virtual_nodes: int, cells_bits: int) -> list[int]:
    """Shard that owns each of 2^cells_bits equal cells of the ring: that of the next virtual node clockwise."""
    n = 1 << cells_bits
    taken: dict[int, int] = {}
    for s in range(shards):  # a shard more leaves the others' nodes where they are
        for v in range(virtual_nodes):
            at = int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big") >> (64 - cells_bits)
            while at in taken and len(taken) < n:
                at = (at + 1) % n
            taken.setdefault(at, s)
    owners, owner = [0] * n, taken[min(taken)]
    for cell in range(n - 1, -1, -1):
        owner = taken.get(cell, owner)
        owners[cell] = owner
    return owners


def deal(counts: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (cell, first rank, end rank, shard, first slot) that place all keys of the cells.

    A cell's keys go to its owner while that has room; what doesn't fit goes on clockwise to the next cells' owners.
    Shards hold floor or ceil of the mean, so counts differ by one at most.
    """
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slot = [0] * shards
    runs, over = [], []

    def place(cell: int, lo: int, hi: int, shard: int) -> int:
        n = min(hi - lo, room[shard])
        if n:
            runs.append((cell, lo, lo + n, shard, slot[shard]))
            room[shard] -= n
            slot[shard] += n
        return lo + n

    for cell, count in enumerate(counts):
        rest = place(cell, 0, count, owners[cell])
        if rest < count:
            over.append((cell, rest, count))
    n = len(counts)
    for cell, lo, hi in over:
        at = cell
        while lo < hi:
            at = (at + 1) % n
            lo = place(cell, lo, hi, owners[at])
    return runs


def small_table(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A table of a bounded number of whole numbers, from one text literal."""
    text = ";".join(",".join(map(str, r)) for r in rows)
    parts = F.split(F.col("r"), ",")
    return spark.range(1).select(F.explode(F.split(F.lit(text), ";")).alias("r")).where("r <> ''").select(*[parts[k].cast("long").alias(c) for k, c in enumerate(columns)])


def shard(docs: DataFrame, shards: int = 16, virtual_nodes: int = 64, cells_bits: int = 14, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for every row.

    The key's hash gives a place on a ring of 2^cells_bits cells; each cell belongs to the next of shards x virtual_nodes
    virtual nodes clockwise. Loads are bounded by the mean rounded up or down (law `rows`), and rows that a full shard
    can't take go on clockwise. Only the ring's histogram, of fixed length, comes to the driver; the rows' ranks in a
    cell give their places. Size: UTF-8 bytes of the text plus 1. Null text: size 1, crc 0 (of no bytes). Null keys
    share one place. Repeated rows are counted before the shuffle and dealt out again from their counts. An empty table
    gives no rows. Other columns are left out.
    """
    spark = docs.sparkSession
    place = F.shiftrightunsigned(F.xxhash64(F.lit("ring"), F.col(key)), 64 - cells_bits).cast("int")
    n = 1 << cells_bits
    histogram = dict(docs.select(place.alias("cell")).groupBy("cell").count().collect())  # 2^cells_bits rows at most
    runs = small_table(spark, deal([histogram.get(c, 0) for c in range(n)], ring_owners(shards, virtual_nodes, cells_bits), shards), ["cell", "lo", "hi", "shard", "slot0"])
    rows = docs.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        place.alias("cell"),
        F.xxhash64(F.lit("order"), F.col(key)).alias("h"),
    )
    once = rows.groupBy("cell", "h", "key", "size", "text_crc32").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("cell").orderBy("h", "key", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1))
    blocks = once.withColumn("rank0", F.coalesce(before, F.lit(0))).withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {REPEAT_BLOCK}"))))
    each = blocks.withColumn("k", F.explode(F.sequence(F.col("block") * REPEAT_BLOCK, F.least(F.col("n"), (F.col("block") + 1) * REPEAT_BLOCK) - 1)))
    ranked = each.select("cell", "key", "size", "text_crc32", (F.col("rank0") + F.col("k")).alias("rank"))
    placed = ranked.join(F.broadcast(runs.withColumnRenamed("cell", "at")), (F.col("cell") == F.col("at")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return placed.select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("slot0") + F.col("rank") - F.col("lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_sharding": op2_sharding}
ORACLES: dict[str, str] = {}
