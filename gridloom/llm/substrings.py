"""Substring dedup: suffix automata of reference shards give matching statistics of the passages routed to them.

Automata of all shards broadcast to all documents would cost the square of the corpus, so passages are routed: the
smallest hash of the short word grams in a window names its shard. Equal windows have equal shards, wherever they are;
each shard's automaton is built where its passages meet. Shards of many passages are divided by a further smallest hash
of the window's grams, and so on; equal windows stay together at every level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import release, staged
from .words import Words, grams, mix, powers, ranges, signed, sliding_min, text_bytes, words

#: Words of the grams whose smallest hash names a window's shard.
GRAM = 8
#: Different passages of a shard that one automaton takes; a shard of more is divided at the next level.
MOST = 2000
#: At the last level a shard is one window and its passages are equal.
LEVELS = 2
#: Crowded shards whose names are sent to all tasks; more of them are joined to the documents.
MOST_HOT = 1 << 20
#: A row's own identity: its key and 64 bits of its text.
ROW = ["doc", "a"]


class SuffixAutomaton:
    """Of several word sequences, grown online; states hold the longest length and the suffix link."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _clone(self, p: int, q: int, c: int) -> int:
        new = len(self.next)
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def add(self, sequence: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in sequence:
            if (q := nxt[last].get(c)) is not None:  # the sequence so far is known already
                last = q if length[q] == length[last] + 1 else self._clone(last, q, c)
                continue
            new = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
            last = new

    def matches(self, sequence: list[int], window: int) -> list[bool]:
        """For each window of the sequence: does it lie in a sequence added before? From the matching statistics."""
        nxt, link, length = self.next, self.link, self.length
        state = n = 0
        out = []
        for i, c in enumerate(sequence, 1):
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                n += 1
            if i >= window:
                out.append(n >= window)
        return out


def window_shards(h: np.ndarray, window: int, level: int) -> list[np.ndarray]:
    """Shards of each window of a document's words (hashes), at each level up to this."""
    size = min(GRAM, window)
    g = grams(h, size)
    out = [sliding_min(g, window - size + 1)]
    for k in range(1, level + 1):
        finer = grams(h, window) if k == LEVELS else sliding_min(mix(g + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)), window - size + 1)
        out.append(mix(out[-1] * np.uint64(0xD6E8FEB86659FD93) + finer))
    return out


def _runs(w: Words, d: int, window: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one document: shards of runs of windows of one shard, their shards a level above, first windows, ends, and hashes of the runs' words."""
    h = w.hash[w.at[d] : w.at[d + 1]]
    shards = window_shards(h, window, level)
    key = shards[-1]
    start = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    end = np.append(start[1:], len(key))
    up, down = powers(len(h) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[:-1])])
    last = end + window - 1
    passage = mix((sums[last] - sums[start]) * down[start] + (last - start).astype(np.uint64))
    return signed(key[start]), signed(shards[max(0, level - 1)][start]), start, end, signed(passage)


ROUTED = "shard long, passage long, doc long, a long, at long"


def _route(window: int, level: int, hot=None):
    """Runs of windows of one shard of (doc, a, text), and from level 1 on of those in hot shards alone, which are broadcast
    or listed in a fourth column. at: first window and number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(2)]
            for i, j in ranges(offsets):
                w = words(data, offsets, i, j)
                out: list[list] = [[] for _ in range(4)]
                for d in np.flatnonzero(np.diff(w.at) >= window).tolist():
                    if level:
                        names = hot.value if hot else batch.column(3)[i + d].values.to_numpy()
                        is_hot = lambda x: names[np.minimum(np.searchsorted(names, x), len(names) - 1)] == x  # noqa: B023, E731
                        before = signed(window_shards(w.hash[w.at[d] : w.at[d + 1]], window, level - 1)[-1])
                        if not is_hot(before[np.append(True, before[1:] != before[:-1])]).any():
                            continue
                    key, above, start, end, passage = _runs(w, d, window, level)
                    if level:
                        some = is_hot(above)
                        key, start, end, passage = key[some], start[some], end[some], passage[some]
                    for column, x in zip(out, (key, passage, start << 32 | end - start, np.full(len(key), i + d)), strict=True):
                        column.append(x)
                if out[0]:
                    key, passage, at, own = map(np.concatenate, out)
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (key, passage, *(r[own] for r in rows), at))], [x.split()[0] for x in ROUTED.split(", ")])

    return run


def _words_of(window: int):
    """(shard, passage, doc, words) of the passages that a row (doc, text, owned: level, shard, passage) owns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            docs, owned = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for i, j in ranges(offsets, 1 << 19):
                w = words(data, offsets, i, j)
                out: list[list] = [[] for _ in range(4)]
                for d in range(j - i):
                    mine = owned[i + d].values
                    level, shard, passage = (mine.field(c).to_numpy(zero_copy_only=False) for c in ("level", "shard", "passage"))
                    for k in np.unique(level).tolist():
                        wanted = {*zip(shard[level == k].tolist(), passage[level == k].tolist(), strict=True)}
                        key, _, start, end, runs = _runs(w, d, window, k)
                        for s, p, t, e in zip(key.tolist(), runs.tolist(), start.tolist(), end.tolist(), strict=True):
                            if (s, p) in wanted:
                                wanted.discard((s, p))
                                lo, hi = w.start[w.at[d] + t], w.end[w.at[d] + e + window - 2]
                                for column, x in zip(out, (s, p, int(docs[i + d]), b" ".join(w.data[lo:hi].tobytes().split()).decode()), strict=True):
                                    column.append(x)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int64()] * 3 + [pa.string()], strict=True)], ["shard", "passage", "doc", "words"])

    return run


FOUND = "shard long, passage long, first long, found binary"


def _match(window: int):
    """Stream passages sorted by shard and document: match each with the automaton of smaller documents' passages."""

    def shard_rows(rows: list[tuple]) -> list[bytes | None]:
        out: list[bytes | None] = []
        if len(rows) == 1:
            return [None]
        automaton, ids, waiting = SuffixAutomaton(), {}, []
        for k, (_, _, doc, text) in enumerate(rows):
            sequence = [ids.setdefault(x, len(ids)) for x in text.encode().split()]
            if waiting and waiting[-1][0] != doc:
                for _, s in waiting:
                    automaton.add(s)
                waiting = []
            hits = automaton.matches(sequence, window) if k else [False]
            out.append(np.packbits(hits).tobytes() if any(hits) else None)
            if not all(hits):
                waiting.append((doc, sequence))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def emit(done: list[tuple]) -> pa.RecordBatch:
            found: list[bytes | None] = []
            i = 0
            while i < len(done):
                j = i + 1
                while j < len(done) and done[j][0] == done[i][0]:
                    j += 1
                found += shard_rows(done[i:j])
                i = j
            cols = [*zip(*(r[:3] for r in done), strict=True)]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(found, pa.binary())], [x.split()[0] for x in FOUND.split(", ")])

        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            cut = len(rows)
            while cut and rows[cut - 1][0] == rows[-1][0]:
                cut -= 1
            if cut:
                yield emit(rows[:cut])
                rows = rows[cut:]
        if rows:
            yield emit(rows)

    return run


def _shared_runs(docs: DataFrame, window: int) -> DataFrame:
    """Runs of the shards that different documents share, with their level."""
    spark, out, level = docs.sparkSession, None, 0
    rows = staged(docs.mapInArrow(_route(window, 0), ROUTED), "runs")
    while True:
        # written, so that the join of a crowded shard's runs is one that Spark can split
        names = staged(rows.groupBy("shard").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("shard"), "names")
        mine = staged(rows.join(names, "shard").withColumn("level", F.lit(level)), "shared")
        release(rows, names)
        sizes = mine.groupBy("shard", "passage").agg(F.lit(1).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
        hot = staged(sizes.where(F.col("n") > MOST).select("shard"), "hot")
        n = 0 if level == LEVELS else hot.count()
        kept = mine.join(hot, "shard", "left_anti") if n else mine
        out = kept if out is None else out.unionByName(kept)
        if not n:
            return staged(out, "shared")
        level += 1
        if n <= MOST_HOT:
            names = spark.sparkContext.broadcast(np.sort(hot.toArrow()["shard"].to_numpy()))  # bounded by MOST_HOT
            again = docs.mapInArrow(_route(window, level, names), ROUTED)
        else:
            crowded = mine.join(hot, "shard").groupBy(*ROW).agg(F.sort_array(F.collect_set("shard")).alias("hot"))
            again = docs.join(crowded, ROW).select(*ROW, "text", "hot").mapInArrow(_route(window, level), ROUTED)
        rows = staged(again, "runs")


def removed_windows(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc, a, at, found) for docs (doc, a, text): of a run of windows, those that a smaller document has.

    at: first window << 32, and number of windows; found: a bitmap of them, or null for all. Equal passages of a shard are
    one, of the smallest document that has it; the shard's automaton takes them in the order of these documents.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _shared_runs(docs, window)
    owners = rows.groupBy("level", "shard", "passage").agg(F.min(F.struct(*ROW)).alias("owner"))
    owned = owners.groupBy("owner").agg(F.collect_list(F.struct("level", "shard", "passage")).alias("owned")).select("owner.*", "owned")
    texts = docs.join(owned, ROW).select("doc", "text", "owned").mapInArrow(_words_of(window), "shard long, passage long, doc long, words string")
    ordered = texts.repartition(n, "shard").sortWithinPartitions("shard", "doc", "passage")
    found = staged(ordered.mapInArrow(_match(window), FOUND), "found")
    hits = rows.join(found, ["shard", "passage"]).where("doc > first or found is not null")
    return hits.select(*ROW, "at", F.when(F.col("doc") <= F.col("first"), F.col("found")).alias("found"))


def drop_repeats(docs: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept) for every row; kept: the words that stay, joined by one space.

    A word goes when it lies in a window of consecutive words that also starts in a document of smaller key. Null or
    short texts (fewer words than a window) keep all. Rows that repeat a key are documents of that key, whatever their
    texts: none of them removes anything of another. A null key is smaller than any other. Extra columns are left out.
    Empty table: no rows. Shards of many different passages are divided, so that no automaton grows with a hot passage.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(whole).alias("a"), F.col(text).alias("text"))
    hits = removed_windows(base, window).groupBy(*ROW).agg(F.collect_set(F.struct("at", "found")).alias("hits"))
    rows = base.join(hits, ROW, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, gone, kept = [], [], []
            for t, hits in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                ws = (t or "").encode().split()
                if hits.is_valid and len(hits.values):
                    edge = np.zeros(len(ws) + 1, np.int32)
                    v = hits.values
                    for at, found in zip(v.field("at").to_pylist(), v.field("found").to_pylist(), strict=True):
                        t0, n = at >> 32, at & (1 << 32) - 1
                        at = t0 + (np.arange(n) if found is None else np.flatnonzero(np.unpackbits(np.frombuffer(found, np.uint8), count=n)))
                        np.add.at(edge, at, 1)
                        np.subtract.at(edge, at + window, 1)
                    stays = (np.cumsum(edge)[:-1] == 0).tolist()
                    left = [w for w, s in zip(ws, stays, strict=True) if s]
                else:
                    left = ws
                ns.append(len(ws))
                gone.append(len(ws) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["doc", "n_words", "n_removed", "kept"])

    out = rows.select("doc", "text", "hits").mapInArrow(run, "doc long, n_words long, n_removed long, kept string")
    return out.withColumn("doc", F.when(F.col("doc") > -(1 << 63), F.col("doc"))).withColumnRenamed("doc", key)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), 50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {"op9_substring_dedup": op9_substring_dedup}
ORACLES = {
    "op9_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM w),
k AS (SELECT doc_id, j, ws[j] AS word, CASE WHEN j + 49 <= len(ws) THEN md5(array_to_string(ws[j:j + 49], ' ')) END AS win FROM p),
f AS (SELECT win, min(doc_id) AS first_doc FROM k WHERE win IS NOT NULL GROUP BY win HAVING count(DISTINCT doc_id) > 1),
h AS (SELECT k.doc_id, k.j, k.word, coalesce(f.first_doc < k.doc_id, false) AS hit FROM k LEFT JOIN f ON k.win = f.win),
c AS (SELECT doc_id, j, word, max(hit::INT) OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM h),
a AS (SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY j) FILTER (WHERE gone = 0), '') AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.n_words, 0) AS n_words, coalesce(a.n_removed, 0) AS n_removed, sha256(coalesce(a.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id
"""
}
