"""Embedding near-dedup: product quantisation over coarse inverted lists, reranked by exact cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components, labels
from .nearjoin import _groups, _starts
from .staging import staged

#: Vectors of one block of a large inverted list.
BLOCK = 512
#: Pairs that are looked at together.
PAIRS = 4096


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(1) / 2
    return np.concatenate([np.argmin(half - x[i : i + 4096] @ centres.T, 1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


class Quantiser:
    """Coarse centres at two levels and codebooks of the rest's subspaces, fitted on a sample of unit vectors.

    A list is a centre and one of the finer centres, which all centres share; with one finer centre, it is 0.
    """

    def __init__(self, sample: np.ndarray, lists: int, finer: int = 1, subspaces: int = 8, codes: int = 64, seed: int = 7):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.cuts = [int(c) for c in np.linspace(0, dim, min(subspaces, dim) + 1)]
        self.centres = _kmeans(sample, lists, rng)
        rest = sample - self.centres[_nearest(sample, self.centres)]
        self.fine = _kmeans(rest, finer, rng) if finer > 1 else np.zeros((1, dim))
        rest = rest - self.fine[_nearest(rest, self.fine)]
        self.gaps, self.fine_gaps = _gaps(self.centres), _gaps(self.fine)
        self.books = [_kmeans(rest[:, a:b], codes, rng) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]

    def home(self, x: np.ndarray) -> np.ndarray:
        """Each vector's own list."""
        c = _nearest(x, self.centres)
        return c * len(self.fine) + _nearest(x - self.centres[c], self.fine)

    def centre(self, lists: np.ndarray) -> np.ndarray:
        return self.centres[lists // len(self.fine)] + self.fine[lists % len(self.fine)]

    def code(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of vectors' residuals to their lists' centres, and the distances between residuals and codes."""
        rest = x - self.centre(own)
        codes = np.stack([_nearest(rest[:, a:b], book) for (a, b), book in zip(zip(self.cuts, self.cuts[1:], strict=False), self.books, strict=True)], 1).astype(np.uint8)
        return codes, np.linalg.norm(rest - self.decoded(codes), axis=1)

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([book[codes[:, k]] for k, book in enumerate(self.books)], 1)

    def tables(self, residual: np.ndarray) -> list[np.ndarray]:
        """Squared distances of queries' residuals to all codes, by subspace."""
        return [((residual[:, a:b, None] - book.T[None]) ** 2).sum(1) for (a, b), book in zip(zip(self.cuts, self.cuts[1:], strict=False), self.books, strict=True)]

    def probes(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(vector, list) of every list whose cell begins within reach of the vector."""
        who, c = np.nonzero(_within(x, self.centres, self.gaps, reach))
        if len(self.fine) == 1:
            return who, c
        again, f = np.nonzero(_within(x[who] - self.centres[c], self.fine, self.fine_gaps, reach))
        return who[again], c[again] * len(self.fine) + f

    def reaches(self, x: np.ndarray, at: np.ndarray, lists: np.ndarray, reach: float) -> np.ndarray:
        """Does vector x[at] probe this list, pair by pair?

        Centres are compared once a vector, finer ones once a vector and centre, PAIRS of these at a time.
        """
        c, f = np.divmod(lists, len(self.fine))
        out = _within(x, self.centres, self.gaps, reach)[at, c]
        if len(self.fine) == 1:
            return out
        maybe = np.flatnonzero(out)
        pairs, pair = np.unique(at[maybe] * len(self.centres) + c[maybe], return_inverse=True)
        order = np.argsort(pair, kind="stable")
        for lo in range(0, len(pairs), PAIRS):
            who, own = np.divmod(pairs[lo : lo + PAIRS], len(self.centres))
            mine = order[slice(*np.searchsorted(pair[order], [lo, lo + PAIRS]))]
            out[maybe[mine]] = _within(x[who] - self.centres[own], self.fine, self.fine_gaps, reach)[pair[mine] - lo, f[maybe[mine]]]
        return out


def _gaps(c: np.ndarray) -> np.ndarray:
    return ((c**2).sum(1)[:, None] + (c**2).sum(1) - 2 * c @ c.T).clip(0) ** 0.5


def _within(x: np.ndarray, c: np.ndarray, gaps: np.ndarray, reach: float) -> np.ndarray:
    """Does a centre's cell begin within reach? It begins at the plane half way between the centre and the vector's own."""
    d2 = (x**2).sum(1)[:, None] + (c**2).sum(1) - 2 * x @ c.T
    own = d2.argmin(1)
    return d2 - d2[np.arange(len(x)), own][:, None] <= 2 * gaps[own] * reach + 1e-9


def scaled(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision, of rows that are finite and not 0; the largest component is 1 before the norm is taken."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, initial=0.0, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def matrix(values: pa.Array, kind=np.float64) -> np.ndarray:
    """Lists of one length, without nulls, as rows."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(values), -1)


def near_vectors(table: DataFrame, cosine: float = 0.95, sample_rows: int = 20_000, most_lists: int = 1024, spread: float = 2.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Two vectors are linked when their cosine in double precision is at least this. Vectors that are null, zero, of another
    length than most, or hold null or non-finite components link with nothing; very large and small ones are scaled
    before their norm is taken. Equal vectors count once, with their number.
    The index (coarse centres and codebooks) is fitted on at most sample_rows vectors, those with the smallest hashes;
    every vector is indexed. There are twice as many lists as the root of the number of vectors: up to most_lists centres,
    and beyond that each is divided by finer centres. With r the distance that the cosine allows, a step of r in any
    direction goes r / sqrt(dim) toward a given cell on average; a query probes all lists whose cells begin within spread
    times that, with no cap on their number (spread = sqrt(dim) probes all that can hold a neighbour). It passes the codes
    whose table-lookup distance, less the code's own error, lies within r, so coding misses nothing; passed vectors are
    ranked by exact cosine. A link counts for both its vectors, also where only one of them probes the other's list.
    Tests measure the recall against brute force. Lists of more than BLOCK vectors are split.
    Rows that repeat a key count as vectors of their own. Null keys are left out of links. Extra columns are left out.
    Empty table: no rows.
    """
    spark = table.sparkSession
    kind = np.float32 if table.schema[vector].dataType.simpleString() == "array<float>" else np.float64
    base = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>" if kind == np.float32 else "array<double>").alias("v"))
    length = base.where("v is not null and size(v) > 0").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = length["d"] if length else 0
    valid = F.col("id").isNotNull() & (F.size("v") == dim) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    rows = base.withColumn("good", F.coalesce(valid, F.lit(False)) & F.lit(dim > 0))
    distinct = staged(rows.where("good").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("m")), "vectors")
    n = distinct.count()
    counted = rows.select("id", "good", "v")
    if n:
        sample = scaled(matrix(distinct.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("v").toArrow()["v"]))  # bounded by sample_rows
        wanted = int(2 * n**0.5)
        lists = max(1, min(most_lists, len(sample) // 8, wanted))
        index = Quantiser(sample, lists, max(1, min(len(sample) // 8, -(-wanted // lists)) if wanted > most_lists else 1))
        reach = float(np.sqrt(2 - 2 * cosine)) + 1e-9
        step = spread * reach / dim**0.5
        shared = spark.sparkContext.broadcast(index)  # centres and codebooks: bounded by most_lists and sample_rows

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = shared.value
            for batch in batches:
                for at in range(0, len(batch), 512):
                    part = batch.slice(at, 512)
                    raw = matrix(part.column("v"), kind)
                    x = scaled(raw)
                    who, where = q.probes(x, step)
                    own = q.home(x)
                    ids, ms = (part.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "m"))
                    data = [r.tobytes() for r in raw]
                    yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(ids[who]), pa.array(ms[who]), pa.array(own[who]), pa.array([data[k] for k in who.tolist()], pa.binary())], ["list", "rep", "m", "home", "v"])

        placed = staged(distinct.mapInArrow(place, "list long, rep long, m long, home long, v binary"), "placed")
        # every list is cut in blocks of members and blocks of queries; a pair of blocks is a group
        mine = F.col("home") == F.col("list")
        blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK).cast("int"))
        cut = staged(placed.groupBy("list").agg(blocks(F.sum(mine.cast("int"))).alias("hs"), blocks(F.count("*")).alias("qs")), "cut")
        both = placed.join(cut, "list")
        block = lambda c, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(c)).cast("int")
        members = both.where(mine).select("list", block("hs", 1).alias("h"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"), F.lit(1).alias("member"), "rep", "m", "home", "v")
        queries = both.select("list", F.explode(F.sequence(F.lit(0), F.col("hs") - 1)).alias("h"), block("qs", 2).alias("q"), F.lit(0).alias("member"), "rep", "m", "home", "v")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = members.unionByName(queries).repartition(parts, "list", "h", "q").sortWithinPartitions("list", "h", "q", F.desc("member"))
        links = staged(dealt.mapInArrow(_rank(shared, cosine, reach, step, kind), "rep long, links long, joined long"), "links")
        classes = components(links.where("rep <> joined"), "rep", "joined").withColumnRenamed("node", "rep")
        found = links.groupBy("rep").agg(F.sum("links").alias("links")).join(classes, "rep", "left")
        found = distinct.join(found, "rep", "left").select("v", "rep", "m", "links", "component")
        counted = counted.join(found, "v", "left")
    else:
        counted = counted.select("*", *(F.lit(None).cast("long").alias(c) for c in ("rep", "m", "links", "component")))
    own = F.when(F.col("good"), F.coalesce("component", "rep")).otherwise(F.col("id"))
    return counted.select(
        F.col("id").alias(key), F.when(F.col("good"), F.coalesce("links", F.lit(0)) + F.col("m") - 1).otherwise(0).cast("long").alias("n_links"),
        own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"),
    )


def _rank(shared, cosine: float, reach: float, step: float, kind):
    """Of groups of members, then queries (list, h, q, member, rep, m, home, v): links by exact cosine, and a forest of those linked."""

    def group(own: int, ids: np.ndarray, weight: np.ndarray, home: np.ndarray, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q = shared.value
        codes, error = q.code(x[:n], np.full(n, own))
        nodes, node = np.unique(ids, return_inverse=True)
        counts, ends = np.zeros(len(nodes), np.int64), []
        centre = q.centre(np.array([own]))
        for at in range(n, len(ids), 256):
            ask = x[at : at + 256]
            d2 = np.zeros((len(ask), n))
            for k, table in enumerate(q.tables(ask - centre)):
                d2 += table[:, codes[:, k]]
            a, b = np.nonzero(np.sqrt(d2) <= reach + error + 1e-9)
            cosines = [np.einsum("ij,ij->i", ask[a[k : k + PAIRS]], x[b[k : k + PAIRS]]) for k in range(0, len(a), PAIRS)]
            sure = (np.concatenate([np.zeros(0), *cosines]) >= cosine) & (ids[at + a] != ids[b])
            a, b = a[sure] + at, b[sure]
            np.add.at(counts, node[a], weight[b])
            one = ~q.reaches(x[:n], b, home[a], step)  # these members don't ask for the query where it lives
            np.add.at(counts, node[b[one]], weight[a[one]])
            ends.append((node[a], node[b]))
        a, b = (np.concatenate([np.zeros(0, np.int64), *(e[k] for e in ends)]) for k in (0, 1))
        low = labels(len(nodes), a, b)
        some = np.unique(np.concatenate([a, b]))
        return nodes[some], counts[some], nodes[low[some]]

    def f(columns: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        lists, h, q, member, rep, m, home, v = columns
        start = _starts(lists, h, q)
        for lo, hi in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
            if n := int(member[lo:hi].sum()):
                x = scaled(np.frombuffer(b"".join(v[lo:hi].to_pylist()), kind).reshape(hi - lo, -1))
                yield group(int(lists[lo]), rep[lo:hi], m[lo:hi], home[lo:hi], x, n)

    return _groups(f, 3, ["rep", "links", "joined"])


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.95)


QUERIES = {"op4_embedding_dedup": op4_embedding_dedup}
ORACLES = {
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, (SELECT min(y) FROM r WHERE r.x = e.vec_id) AS component_id,
  e.vec_id = (SELECT min(y) FROM r WHERE r.x = e.vec_id) AS kept FROM embeddings e
"""
}
