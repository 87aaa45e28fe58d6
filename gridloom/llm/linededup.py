"""Line dedup: range-partitioned line hashes give compressed keep bitmaps of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import free_names, release, staged

UPPER, SPACES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "\x20\x09\x0a\x0b\x0c\x0d"
MARKS = "kind int, h1 long, h2 long, doc long, a long, b long, pos array<int>"
_NAMES = ["kind", "h1", "h2", "doc", "a", "b", "pos"]
_TYPES = [pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int32())]
#: A row's own identity: its key and 128 bits of its text.
ROW = ["doc", "a", "b"]


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case.

    Lines of ASCII alone take lower(), which then changes A-Z only and is much faster than translate().
    """
    ascii_only = F.octet_length(line) == F.length(line)
    return F.btrim(F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, UPPER, UPPER.lower())), F.lit(SPACES))


def first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream lines sorted by (h1, h2, doc, a, b, pos) and mark those to drop.

    kind 0: lines of doc to drop. kind 1: lines of the partition's first hash, which may have begun in a partition
    before. kind 2: the first document of the partition's last hash.
    """
    leading = current = first_doc = None
    for batch in batches:
        h1, h2, doc, a, b, pos = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(6))
        if not len(h1):
            continue
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = current != (h1[0], h2[0])
        if leading is None:
            leading = (h1[0], h2[0])
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        first = np.where(start >= 0, doc[np.maximum(start, 0)], first_doc if first_doc is not None else doc[0])
        lead = (h1 == leading[0]) & (h2 == leading[1])
        drop = (doc != first) | lead
        at = np.flatnonzero(drop)
        current, first_doc = (h1[-1], h2[-1]), first[-1]
        if len(at):  # one row for each document's lines of one hash
            cut = np.zeros(len(at), bool)
            cut[0] = True
            for x in (h1[at], h2[at], doc[at], a[at], b[at]):
                cut[1:] |= x[1:] != x[:-1]
            s = np.flatnonzero(cut)
            lists = pa.ListArray.from_arrays(pa.array(np.append(s, len(at)), pa.int32()), pa.array(pos[at], pa.int32()))
            k = at[s]
            yield pa.RecordBatch.from_arrays([pa.array(lead[k].astype(np.int32)), *(pa.array(x[k]) for x in (h1, h2, doc, a, b)), lists], _NAMES)
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((2, *current, first_doc, 0, 0, []), _TYPES, strict=True)], _NAMES)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for n, drops in zip(batch.column(3).to_pylist(), batch.column(4), strict=True):
            keep = np.ones(n, np.uint8)
            if drops.is_valid:
                keep[drops.values.to_numpy(zero_copy_only=False)] = 0
            out.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.binary())], [*ROW, "n_lines", "keep"])


def _row(key: str, text: str) -> list[Column]:
    """Key and two hashes of the text; a null key is smaller than any other."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))), F.xxhash64(whole), F.xxhash64(F.lit("second"), whole)]


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """(doc, a, b, drops): places of the lines that repeat one of a smaller document, for rows that have any."""
    lines = docs.select(*(c.alias(n) for c, n in zip(_row(key, text), ROW, strict=True)), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("pos", "line"))
    keyed = lines.select(*ROW, "pos", line_key(F.col("line")).alias("k")).where(F.length("k") >= least)
    # written, as the ranges' sample and the shuffle both read them
    hashes = staged(keyed.select(F.xxhash64("k").alias("h1"), F.xxhash64(F.lit("second"), F.col("k")).alias("h2"), *ROW, "pos"), "lines")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["h1", "h2", *ROW, "pos"]
    marks = staged(hashes.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(first_occurrences, MARKS), "marks")
    release(hashes)
    # at most one row a partition; a hash that begins before a partition is the last hash of those before
    heads = marks.where("kind = 2").groupBy("h1", "h2").agg(F.min("doc").alias("first"))
    pending = marks.where("kind = 1").join(F.broadcast(heads), ["h1", "h2"], "left")
    late = pending.groupBy("h1", "h2").agg(F.min("doc").alias("own"))
    pending = pending.join(F.broadcast(late), ["h1", "h2"]).where(F.col("doc") > F.least("first", "own")).select(*ROW, "pos")
    drops = marks.where("kind = 0").select(*ROW, "pos").unionByName(pending)
    return drops.groupBy(*ROW).agg(F.flatten(F.collect_list("pos")).alias("drops"))


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """(doc, a, b, n_lines, keep): for each row, its lines and a zlib-compressed bitmap of those that stay, first line first.

    doc: the key; a, b: hashes of the row's text (together 128 bits), which tell rows of one key apart.
    A line's key is the line stripped of white space and with A-Z in lower case. Keys of least code points or more that
    lie in two documents stay only in the smallest key column's document (there all of them). Lines' hashes (128 bits)
    are dealt out by range over (hash, document, place), so a very common line spans partitions; each is streamed in
    order and only what repeats is written. Null or empty text is one empty line. Rows that repeat a key are rows of one
    document, whatever their texts: each has its own bitmap, and none loses a line for another. A null key is smaller than
    any other. Empty table: no rows.
    """
    lines = F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    rows = docs.select(*(c.alias(n) for c, n in zip(_row(key, text), ROW, strict=True)), lines.alias("n_lines"))
    return rows.join(repeated_lines(docs, key, text, least), ROW, "left").select(*ROW, "n_lines", "drops").mapInArrow(_bitmaps, "doc long, a long, b long, n_lines int, keep binary")


def kept_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """docs with _n_lines, _n_dropped and _kept (in place of columns of these names): the text of the lines that stay, by
    the rows' bitmaps. All other columns stay as they are."""
    docs = docs.drop(*({"_n_lines", "_n_dropped", "_kept"} - {key, text}))
    *row, keep_name = free_names(docs, *ROW, "keep")
    x = docs.withColumns(dict(zip(row, _row(key, text), strict=True)))
    maps = keep_bitmaps(docs, key, text, least).groupBy(*ROW).agg(F.max("keep").alias(keep_name)).withColumnsRenamed(dict(zip(ROW, row, strict=True)))
    x = x.join(maps, row).drop(*row)
    names = [c for c in x.columns if c != keep_name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, ds, kept = [], [], []
            for t, keep in zip(batch.column(text).to_pylist(), batch.column(keep_name).to_pylist(), strict=True):
                lines = (t or "").split("\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
                gone = len(lines) - int(bits.sum())
                ns.append(len(lines))
                ds.append(gone)
                kept.append("\n".join(x for x, b in zip(lines, bits.tolist(), strict=True) if b) if gone else (t or ""))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(ns, pa.int64()), pa.array(ds, pa.int64()), pa.array(kept, pa.string())], [*names, "_n_lines", "_n_dropped", "_kept"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.schema if f.name != keep_name)
    return x.mapInArrow(run, f"{schema}, _n_lines long, _n_dropped long, _kept string")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = kept_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return x.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


SQL = """
WITH l AS (
  SELECT doc_id, i, s[i] AS line, lower_ascii AS k FROM (
    SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)
  ), LATERAL (SELECT translate(trim(s[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii)
),
f AS (SELECT k, min(doc_id) AS first_doc FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE f.k IS NOT NULL AND l.doc_id > f.first_doc) AS n_dropped,
  sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE f.k IS NULL OR l.doc_id <= f.first_doc), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.k = f.k GROUP BY l.doc_id
"""

QUERIES = {"op6_line_dedup": op6_line_dedup}
ORACLES = {"op6_line_dedup": SQL}
