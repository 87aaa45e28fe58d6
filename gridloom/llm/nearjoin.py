"""N-gram Jaccard self-join: MinHash bands find candidates, full n-gram sets verify them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components, labels
from .staging import release, staged
from .words import distinct, each_chunk, grams, mix, signed

#: Members of one block of a large bucket or cluster; blocks are compared in pairs.
BLOCK = 256
#: Pairs of signatures that are compared at once.
MOST_PAIRS = 1 << 17


def bands_for(similarity: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """(bands, rows): the fewest bands of so many rows that a pair at the similarity shares one with this probability."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows))), rows


def shingle_sets(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each document, one after the other, and where they begin. Fewer words make one gram."""
    sets = []
    for d in range(len(at) - 1):
        h = hashes[at[d] : at[d + 1]]
        sets.append(distinct(grams(h, min(n, len(h))) + np.uint64(len(h) if len(h) < n else 0)) if len(h) else h[:0])
    return (np.concatenate(sets) if sets else hashes[:0]), np.cumsum([0, *map(len, sets)])


def _signatures(n: int, bands: int, rows: int):
    rng = np.random.Generator(np.random.PCG64(20240601))
    xor = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    factor = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for w in each_chunk(batch.column(1)):
                m = w.last - w.first
                sets, begin = shingle_sets(w.hash, w.at, n)
                full = np.flatnonzero(np.diff(begin))
                low = (sets >> np.uint64(32)).astype(np.uint32)
                key, least = np.zeros((bands, len(full)), np.uint64), np.zeros((m, bands * rows), np.uint8)
                for b in range(bands):
                    key[b] = b
                    for r in range(rows):
                        x = (low ^ xor[b * rows + r]) * factor[b * rows + r]
                        if len(full):
                            smallest = np.minimum.reduceat(x, begin[full])
                            least[full, b * rows + r] = smallest
                            key[b] = key[b] * np.uint64(0x9E3779B97F4A7C15) + smallest
                flat = signed(mix(key.T.ravel())) if len(full) else np.zeros(0, np.int64)
                sizes = np.zeros(m + 1, np.int32)
                sizes[full + 1] = bands
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(at, m) for k in (0, 2, 3)), lists, pa.array([r.tobytes() for r in least], pa.binary())], ["doc", "a", "b", "bands", "sig"])
                at += m

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for w in each_chunk(batch.column(1)):
                sets, begin = shingle_sets(w.hash, w.at, n)
                m = w.last - w.first
                data = [sets[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, m), pa.array(data, pa.binary())], ["id", "grams"])
                at += m

    return run


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of sets, i from left and j from right, with Jaccard similarity of at least this.

    An inverted index of the right sets' grams counts what each left set shares with all of them.
    """
    size = np.array([len(s) for s in sets])
    grams_of = np.concatenate([sets[j] for j in right])
    owner = np.repeat(np.arange(len(right)), size[right])
    order = np.argsort(grams_of, kind="stable")
    grams_of, owner = grams_of[order], owner[order]
    a, b = [], []
    for i in left:
        lo, hi = np.searchsorted(grams_of, sets[i], "left"), np.searchsorted(grams_of, sets[i], "right")
        n = hi - lo
        total = int(n.sum())
        if not total:
            continue
        places = np.arange(total) + np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        shared = np.bincount(owner[places], minlength=len(right))
        hit = np.flatnonzero(shared >= similarity * (size[i] + size[right] - shared) - 1e-9)
        hit = right[hit]
        hit = hit[hit != i]
        a.append(np.full(len(hit), i))
        b.append(hit)
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _groups(f: Callable[[list[np.ndarray]], Iterator[tuple]], keys: int, names: list[str]):
    """A mapInArrow function over rows sorted by their first columns (keys of them): f gets whole groups' columns, as many
    groups as a batch ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            if held and not _last_key(held[-1], keys) == _last_key(batch, keys):
                at = _cut(batch, keys)
                yield from _table(f, [*held, batch.slice(0, at)], names)
                held = []
                batch = batch.slice(at)
            held.append(batch)
        if held:
            yield from _table(f, held, names)

    return run


def _last_key(batch: pa.RecordBatch, keys: int) -> list:
    return [batch.column(k)[-1] for k in range(keys)]


def _cut(batch: pa.RecordBatch, keys: int) -> int:
    """Where the last group of a sorted batch begins."""
    last = np.zeros(len(batch), bool)
    for k in range(keys):
        x = batch.column(k).to_numpy(zero_copy_only=False)
        last[1:] |= x[1:] != x[:-1]
    return int(np.flatnonzero(last)[-1]) if last.any() else 0


def _table(f, batches: list[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches)
    if len(table):
        columns = [c.combine_chunks() for c in table.columns]
        for out in f([c if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False) for c in columns]):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where groups of equal keys begin, and the end."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.append(np.flatnonzero(new), len(new))


def _plausible(least: float):
    """Of buckets' block pairs (band, i, j, id, block, sig): a forest (u, v) of the members whose signatures agree in this part."""

    def f(columns: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        band, i, j, ids, block, sig = columns
        sig = np.frombuffer(b"".join(sig.to_pylist()), np.uint8).reshape(len(ids), -1)
        start = _starts(band, i, j)
        begin = np.repeat(start[:-1], np.diff(start))
        n = np.arange(len(ids)) - begin  # members before it in the group
        total = np.concatenate([[0], np.cumsum(n)])
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at = 0
        while at < len(ids):
            end = max(at + 1, int(np.searchsorted(total, total[at] + MOST_PAIRS, "right")) - 1)
            right = np.repeat(np.arange(at, end), n[at:end])
            left = np.arange(len(right)) - np.repeat(total[at:end] - total[at], n[at:end]) + begin[right]
            across = (i[right] == j[right]) | (block[left] != block[right])
            left, right = left[across], right[across]
            near = (sig[left] == sig[right]).mean(1) >= least
            a.append(left[near])
            b.append(right[near])
            at = end
        own = labels(len(ids), np.concatenate(a), np.concatenate(b))
        some = np.flatnonzero(own != np.arange(len(ids)))
        yield ids[some], ids[own[some]]

    return _groups(f, 3, ["u", "v"])


def _verify(similarity: float):
    """Of clusters' block pairs (cluster, i, j, id, m, block, grams), by id: links of each member, and a forest that joins those linked."""

    def f(columns: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        cluster, i, j, ids, weight, block, raw = columns
        start = _starts(cluster, i, j)
        for lo, hi in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
            once = lo + np.unique(ids[lo:hi], return_index=True)[1]  # rows that repeat a text come more than once
            sets = [np.frombuffer(raw[k].as_py(), np.uint64) for k in once.tolist()]
            left, right = np.flatnonzero(block[once] == i[lo]), np.flatnonzero(block[once] == j[lo])
            if not len(left) or not len(right):
                continue
            a, b = linked(sets, left, right, similarity)
            links = np.bincount(a, weight[once][b], len(once))
            if i[lo] != j[lo]:
                links += np.bincount(b, weight[once][a], len(once))
            own = labels(len(once), a, b)
            some = np.flatnonzero(links)
            yield ids[once][some], links[some].astype(np.int64), ids[once][own[some]]

    return _groups(f, 3, ["id", "links", "joined"])


def near_duplicates(docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.99999, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, n_links, copies) for every row.

    Two documents are linked when their sets of n consecutive words (words: what white space separates, unchanged) have
    a Jaccard similarity of at least this. class_id: the smallest key that links reach; n_links: other rows linked
    directly, exact copies included; copies: rows of the same text. Texts of fewer than n words have one gram, all their
    words; texts without words link with equal ones only. Null text: empty. Rows of null key are left out of links. Rows
    that repeat a key with the same text are copies of each other; those with different texts are documents of their own,
    each with its own links. Extra columns are left out. Empty table: no rows.

    Copies are one representative. MinHash bands, as many as the recall at the similarity asks for, are shuffled by hash.
    Members of a bucket whose signatures agree in clearly too small a part (six deviations below the similarity) are no
    candidates; the others, each time as a forest, join candidate clusters, so that clusters don't grow over texts that
    share a band by chance. Within a cluster, full sets are compared by an inverted index, which meets only those that share
    grams. Buckets and clusters of more than BLOCK members are compared in pairs of blocks, so that no task holds a whole one.
    """
    bands, rows = bands_for(similarity, recall)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), F.xxhash64(whole).alias("a"), F.xxhash64(F.lit("second"), whole).alias("b"))
    signed_docs = staged(base.mapInArrow(_signatures(n, bands, rows), "doc long, a long, b long, bands array<long>, sig binary"), "signatures")
    reps = signed_docs.where("doc is not null").groupBy("a", "b").agg(F.min("doc").alias("rep"), F.count("*").alias("m"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    reps = staged(reps.withColumn("id", F.monotonically_increasing_id()), "reps")
    banded = reps.select("id", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("c")).where("c > 1").select("band", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
    hits = staged(_in_blocks(banded.join(shared, "band"), "band", "id"), "hits")
    dealt = hits.join(reps.select("id", "sig"), "id").select("band", "i", "j", "id", "block", "sig").repartition(parts, "band", "i", "j").sortWithinPartitions("band", "i", "j")
    agree = similarity - 6 * (similarity * (1 - similarity) / (bands * rows)) ** 0.5
    clusters = components(dealt.mapInArrow(_plausible(agree), "u long, v long"), "u", "v")
    clusters = staged(clusters.withColumnRenamed("node", "id").withColumnRenamed("component", "cluster"), "clusters")
    release(hits)
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = staged(_in_blocks(clusters.join(sizes, "cluster"), "cluster", "id").join(reps.select("id", "m"), "id"), "members")
    chosen = clusters.select("id").join(reps.select("id", F.col("rep").alias("doc"), "a", "b"), "id")
    sets = staged(base.join(chosen, ["doc", "a", "b"]).select("id", "text").mapInArrow(_sets(n), "id long, grams binary"), "grams")
    release(clusters)
    paired = members.join(sets, "id").select("cluster", "i", "j", "id", "m", "block", "grams").repartition(parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    links = staged(paired.mapInArrow(_verify(similarity), "id long, links long, joined long"), "links")
    release(members, sets)
    classes = staged(components(links.where("id <> joined"), "id", "joined").withColumnRenamed("node", "id"), "classes")
    first = classes.join(reps.select("id", "rep"), "id").groupBy("component").agg(F.min("rep").alias("class"))
    counted = staged(links.groupBy("id").agg(F.sum("links").alias("links")).join(classes.join(first, "component"), "id").select("id", "links", "class"), "counted")
    release(links, classes)
    of_rep = reps.select("a", "b", "id", "rep", "m").join(counted, "id", "left")
    out = signed_docs.select("doc", "a", "b").join(of_rep, ["a", "b"], "left")
    mine = F.col("doc").isNotNull()
    return out.select(
        F.col("doc").alias(key),
        F.when(mine, F.coalesce("class", "rep")).otherwise(F.col("doc")).alias("class_id"),
        F.when(mine, F.coalesce("links", F.lit(0)) + F.col("m") - 1).otherwise(0).cast("long").alias("n_links"),
        F.when(mine, F.col("m")).otherwise(1).cast("long").alias("copies"),
    )


def _in_blocks(rows: DataFrame, group: str, member: str) -> DataFrame:
    """(group, i, j, member, block) of rows (group, member, blocks): a row for every pair of blocks that the member's is in."""
    x = rows.withColumn("block", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return x.select(group, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), member, "block")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_ngram_jaccard_join": op1_ngram_jaccard_join}
ORACLES = {
    "op1_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
s AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT s.a, s.b FROM s JOIN n x ON s.a = x.doc_id JOIN n y ON s.b = y.doc_id WHERE s.both >= 0.8 * (x.n + y.n - s.both)
  UNION ALL SELECT a.doc_id, b.doc_id FROM w a JOIN w b ON coalesce(a.text, '') = coalesce(b.text, '') AND a.doc_id <> b.doc_id WHERE len(a.ws) = 0),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a)
SELECT d.doc_id, (SELECT min(y) FROM r WHERE r.x = d.doc_id) AS class_id, (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links,
  (SELECT count(*) FROM documents e WHERE coalesce(e.text, '') = coalesce(d.text, '')) AS copies
FROM documents d
"""
}
