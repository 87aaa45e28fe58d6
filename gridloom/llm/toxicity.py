"""Toxicity by nearest labelled examples: exact cosine of label-weighted TF-IDF over all terms of the examples, distance-weighted votes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import release, staged
from .words import NOT_LETTER, Words, distinct, each_chunk, signed

#: Examples of a block, whose largest weight of a term bounds what the term adds to any of them.
BLOCK = 32
#: Blocks of largest bound that are scored before the next ones, in turn; then come all others that can hold a neighbour.
FIRST = (4, 12)
#: What sums in single precision can be off by.
SLACK = 2e-5
#: A term that more than this part of the examples hold has its list cut in blocks; shorter lists are added up whole.
DENSE = 8
#: Documents that are scored at once, and postings of short lists that are added up at once.
MOST_DOCS, MOST_WORK = 512, 1 << 17
PIVOTS = 192
#: Postings that are put into blocks at once, and bytes of texts that are counted or scored at once.
STEP, BYTES = 1 << 18, 1 << 19


class Examples:
    """Labelled examples in block-max inverted lists by term; examples of like terms share a block."""

    def __init__(self, index: TermIndex, weights: np.ndarray, vectors: list[tuple[object, float, float, np.ndarray, np.ndarray]], empty: float, vote: float, k: int, slope: float = 1.0, shift: float = 0.0):
        self.index, self.weights, self.empty, self.vote, self.k, self.slope, self.shift = index, weights, empty, vote, k, slope, shift
        self.sent = None
        self.order = _alike([(v[3], v[4]) for v in vectors], len(weights))  # the place of each example among those given
        vectors = [vectors[i] for i in self.order]
        self.ids = np.fromiter((v[0] for v in vectors), object, len(vectors))  # keys of any type
        self.label = np.array([v[1] for v in vectors])
        self.share = np.array([v[2] for v in vectors])  # how many labelled documents the example stands for
        term = np.concatenate([np.zeros(0, np.int32), *(np.asarray(v[3], np.int32) for v in vectors)])
        self.at = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(weights)))])  # term t has postings at[t]..at[t+1]-1
        order = np.argsort(term, kind="stable")
        del term
        self.example = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(v[3]) for v in vectors])[order]
        self.value = np.concatenate([np.zeros(0, np.float32), *(np.asarray(v[4], np.float32) for v in vectors)])[order]
        self.blocked: tuple[np.ndarray, ...] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "sent": None, "blocked": None}

    def shared(self, spark: SparkSession):
        """The model as sent to the executors, once; bounded by the terms of the examples."""
        if self.sent is None:
            self.sent = spark.sparkContext.broadcast(self)
        return self.sent

    def blocks(self) -> tuple[np.ndarray, ...]:
        """Each term's long list or -1, weights by block, list and place, and their largest by list and block; built where they are used."""
        if self.blocked is None:
            count, n = np.diff(self.at), -(-len(self.ids) // BLOCK)
            long = count * DENSE > len(self.ids)
            row = np.where(long, np.cumsum(long) - 1, -1)
            full = np.zeros((n, int(long.sum()), BLOCK), np.float32)
            for a in range(0, len(self.example), STEP):  # few at a time hold little memory
                e = self.example[a : a + STEP]
                of = row[np.searchsorted(self.at, np.arange(a, a + len(e)), "right") - 1]
                some = of >= 0
                full[e[some] // BLOCK, of[some], e[some] % BLOCK] = self.value[a : a + STEP][some]
            self.blocked = row, full, full.max(2, initial=0.0).T.copy()
        return self.blocked

    def vectors(self, own: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, weight) by document from all occurrences: (1 + log of the count) times the term's weight, of length 1."""
        pair, n = np.unique(own * self.index.width + at, return_counts=True)
        own, t = np.divmod(pair, self.index.width)
        x = (1 + np.log(n)) * self.weights[t]
        return own, t, x / np.sqrt(np.bincount(own, x * x))[own]

    def weighed(self, terms: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term, weight) of a bag of terms by hash and their counts."""
        at = np.minimum(np.searchsorted(self.index.terms, terms), self.index.width - 1)
        hit = self.index.terms[at] == terms
        x = (1 + np.log(n[hit])) * self.weights[at[hit]]
        return at[hit], x / np.sqrt((x * x).sum() or 1.0)

    def vector(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term, weight) of one document."""
        return self.vectors(np.zeros(len(at), np.int64), at)[1:]

    def search(self, own: np.ndarray, t: np.ndarray, x: np.ndarray, m: int, but: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each of m documents its k nearest examples of cosine above 0 (ties: the smaller place) and their exact cosines.

        Short lists are added up; with the long lists' largest weights in a block they bound what its examples reach. The
        blocks of largest bound give each document's k-th cosine so far, and blocks whose bound lies below that are passed
        over. Long lists are summed in single precision; examples that are below by no more than that can be off are
        candidates, whose cosines are taken again in double precision. but: of each document, the example to leave out.
        """
        row, full, most = self.blocks()
        n = len(full) * BLOCK
        long = row[t] >= 0
        rows, weights = row[t[long]], x[long]
        cut = np.searchsorted(own[long], np.arange(m + 1))
        part = np.zeros((m, full.shape[1]), np.float32)
        part[own[long], rows] = weights
        own, t, x = own[~long], t[~long], x[~long]
        size, at = self.at[t + 1] - self.at[t], np.searchsorted(own, np.arange(m + 1))
        short, a = np.zeros((m, n)), 0
        work = np.concatenate([[0], np.cumsum(size)])[at]
        while a < m:
            b = max(a + 1, int(np.searchsorted(work, work[a] + MOST_WORK, "right")) - 1)
            s = slice(at[a], at[b])
            taken = _places(self.at[t[s]], size[s])
            add = np.repeat(x[s], size[s])
            add *= self.value[taken]
            cell = np.repeat((own[s] - a) * n, size[s])
            cell += self.example[taken]
            short[a:b] = np.bincount(cell, add, (b - a) * n).reshape(b - a, n)
            a = b
        short = short.reshape(m, -1, BLOCK)
        if but is not None:
            short[np.arange(m), but // BLOCK, but % BLOCK] = -np.inf
        bound = part @ most + short.max(2) + SLACK
        out = np.full(short.shape, -1, np.float32)
        order = np.argsort(-bound, 1, kind="stable")
        best, done = np.full((m, self.k), -1, np.float32), 0
        for size in (*FIRST, bound.shape[1]):
            at = order[:, done : done + size]
            ask = np.zeros(bound.shape, bool)
            np.put_along_axis(ask, at, np.take_along_axis(bound, at, 1) >= best[:, :1] - SLACK, 1)
            for b in np.flatnonzero(ask.any(0)).tolist():
                who = np.flatnonzero(ask[:, b])
                out[who, b] = part[who] @ full[b] + short[who, b]
            done += size
            both = np.concatenate([best, np.take_along_axis(out, at[:, :, None], 1).reshape(m, -1)], 1)
            best = np.partition(both, -self.k, 1)[:, -self.k :]  # the least first
        for i, least in zip(range(m), np.maximum(best[:, 0] - SLACK, -0.5), strict=True):
            b, e = np.nonzero(out[i] >= least)
            mine = slice(cut[i], cut[i + 1])
            cos = full[b[:, None], rows[None, mine], e[:, None]] @ weights[mine] + short[i, b, e]
            at = b * BLOCK + e
            some = np.lexsort((at, -np.round(cos, 12)))[: self.k]
            some = some[cos[some] > 0]
            yield at[some], cos[some]

    def each(self, own: np.ndarray, t: np.ndarray, x: np.ndarray, m: int, but: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for any number of documents, whose terms follow one another."""
        cut = np.searchsorted(own, np.arange(m + 1))
        for a in range(0, m, MOST_DOCS):
            b = min(a + MOST_DOCS, m)
            s = slice(cut[a], cut[b])
            yield from self.search(own[s] - a, t[s], x[s], b - a, None if but is None else but[a:b])

    def nearest(self, t: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k examples nearest to one document and their cosines, exactly."""
        return next(self.each(np.zeros(len(t), np.int64), t, x, 1))

    def voted(self, e: np.ndarray, cos: np.ndarray) -> float:
        """Share of toxic votes."""
        votes = cos**4 * self.share[e]
        return float((votes @ self.label[e] + self.vote * self.empty) / (votes.sum() + self.vote)) if len(e) else self.empty

    def calibrated(self, share: float) -> float:
        """The probability that goes with a share of votes."""
        p = min(max(share, 1e-6), 1 - 1e-6)
        return float(1 / (1 + np.exp(-(self.slope * np.log(p / (1 - p)) + self.shift))))

    def scores(self, own: np.ndarray, at: np.ndarray, m: int) -> Iterator[tuple[float, list[int], list[float]]]:
        """For each of m documents: its score, and the evidence: examples and cosines."""
        if not len(self.ids):
            yield from [(self.empty, [], [])] * m
            return
        for e, cos in self.each(*self.vectors(own, at), m):
            yield self.calibrated(self.voted(e, cos)) if len(e) else self.empty, self.ids[e].tolist(), cos.tolist()

    def calibrate(self, share: np.ndarray, label: np.ndarray) -> None:
        """Fit slope and shift of a logistic curve over examples' shares of votes, each from the others, by Newton steps.

        Examples count as much as the labelled documents they stand for. A weak prior holds slope 1 and shift 0.
        """
        share = np.clip(share, 1e-6, 1 - 1e-6)
        z = np.stack([np.log(share / (1 - share)), np.ones(len(share))], 1)
        of = {float(y): float(s) for y, s in zip(self.label, self.share, strict=True)}
        weight = np.array([of[y] for y in label.tolist()])
        weight /= weight.mean()
        w, prior, hold = np.array([1.0, 0.0]), np.array([1.0, 0.0]), 1.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(z @ w)))
            step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + hold * np.eye(2), z.T @ (weight * (p - label)) + hold * (w - prior))
            w = w - np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.shift = (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def _alike(vectors: list[tuple[list[int], list[float]]], width: int) -> np.ndarray:
    """Examples in the order of the pivot (every n / PIVOTS-th example) that they are nearest to, and of that cosine."""
    n = len(vectors)
    pivots = range(0, n, max(1, n // PIVOTS))
    cos = np.zeros((n, len(pivots)))
    for at in range(0, len(pivots), 16):  # few at a time hold little memory
        full = np.zeros((width, 16), np.float32)
        for k, i in enumerate(pivots[at : at + 16]):
            full[vectors[i][0], k] = vectors[i][1]
        for i, (t, x) in enumerate(vectors):
            cos[i, at : at + 16] = (np.asarray(x, np.float32) @ full[t])[: len(pivots) - at]
    return np.lexsort((np.arange(n), -cos.max(1), cos.argmax(1))) if n else np.zeros(0, np.int64)


#: Words whose terms a worker remembers.
MOST_SEEN = 1 << 17
#: Bytes of word beginnings that are terms beside the words.
PREFIXES = (4, 5, 6, 7, 8)


def _terms(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a chunk, words and beginnings of words, and the place of each one's document in the chunk."""
    own = np.repeat(np.arange(w.last - w.first), np.diff(w.at))
    parts = [(w.hash, own), *((h, own[k]) for h, k in map(w.prefixes, PREFIXES))]
    return signed(np.concatenate([p[0] for p in parts])), np.concatenate([p[1] for p in parts])


class TermIndex:
    """Places of terms in a sorted list of them."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.width = len(terms)
        self.seen = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "width": self.width, "seen": (np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64))}

    def of_words(self, w: Words, u: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each distinct word's places begin in seen, and how many there are. Words met before in this worker are remembered."""
        known, begin, places = self.seen
        at = np.minimum(np.searchsorted(known, u), max(0, len(known) - 1))
        new = np.flatnonzero(known[at] != u) if len(known) else np.arange(len(u))
        if len(new):
            parts = [(u[new], np.arange(len(new))), *((h, k) for h, k in (w.prefixes(n, first[new]) for n in PREFIXES))]
            t, word = signed(np.concatenate([p[0] for p in parts])), np.concatenate([p[1] for p in parts])
            order = np.argsort(t)  # sorted ones are found faster
            t, word = t[order], word[order]
            found = np.minimum(np.searchsorted(self.terms, t), self.width - 1)
            hit = self.terms[found] == t
            order = np.argsort(word[hit], kind="stable")
            size = np.bincount(word[hit], minlength=len(new))
            if len(known) > MOST_SEEN:
                known, begin, places = known[:0], begin[:1], places[:0]
            both = np.concatenate([known, u[new]])
            begin, size = np.concatenate([begin[:-1], len(places) + np.cumsum(size) - size]), np.concatenate([np.diff(begin), size])
            places = np.concatenate([places, found[hit][order]])
            order = np.argsort(both)
            known, (places, begin) = both[order], _taken(places, begin[order], size[order])
            self.seen = known, begin, places
            at = np.searchsorted(known, u)
            if (known[np.minimum(at, len(known) - 1)] != u).any():  # forgotten meanwhile
                self.seen = known[:0], begin[:1], places[:0]
                return self.of_words(w, u, first)
        return begin[at], begin[at + 1] - begin[at]

    def of(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(document in the chunk, place) of each occurrence of a listed term."""
        if not self.width:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        u, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
        begin, size = self.of_words(w, u, first)
        size = size[back]
        own = np.repeat(np.repeat(np.arange(w.last - w.first), np.diff(w.at)), size)
        return own, _taken(self.seen[2], begin[back], size)[0]


def _places(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of runs, one after the other."""
    at = np.repeat(begin - np.cumsum(size) + size, size)
    at += np.arange(len(at))
    return at


def _taken(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values one after the other, and where they begin and end now."""
    return values[_places(begin, size)], np.concatenate([[0], np.cumsum(size)])


def _counts(shared, labelled: bool):
    """Documents that hold each listed term: (at, ones, zeros) by label in the second column, or (at, n) of all; one row
    for each term and partition, and for all documents, at the place after the last term's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        m = index.width
        sums = np.zeros((2 if labelled else 1, m + 1), np.int64)
        for batch in batches:
            at, label = 0, batch.column(1).to_numpy(zero_copy_only=False) if labelled else None
            sums[:, m] += [(label == y).sum() for y in (1, 0)] if labelled else batch.num_rows
            for w in each_chunk(batch.column(0), NOT_LETTER, lower=True, limit=BYTES):
                own, term = index.of(w)
                own, term = np.divmod(distinct(own * m + term), m)
                for k, some in enumerate((label[at + own] == 1, label[at + own] == 0) if labelled else (slice(None),)):
                    sums[k] += np.bincount(term[some], minlength=m + 1)
                at += w.last - w.first
        some = np.flatnonzero(sums.any(0))
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(x[some]) for x in sums)], ["at", "ones", "zeros"] if labelled else ["at", "n"])

    return run


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each document and how often they occur."""
    for batch in batches:
        at = 0
        for w in each_chunk(batch.column(1), NOT_LETTER, lower=True):
            t, own = _terms(w)
            terms, back = np.unique(t, return_inverse=True)
            pair, n = np.unique(own * max(1, len(terms)) + back, return_counts=True)
            own, t = np.divmod(pair, max(1, len(terms)))
            m = w.last - w.first
            cut = pa.array(np.searchsorted(own, np.arange(m + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (terms[t], n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, m), batch.column(2).slice(at, m), *lists], ["_k", "y", "terms", "n"])
            at += m


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different terms of a partition's bags."""
    out = np.zeros(0, np.int64)
    for batch in batches:
        out = distinct(np.concatenate([out, batch.column(0).flatten().to_numpy()]))
    yield pa.RecordBatch.from_arrays([pa.array(out)], ["term"])


def _weighed(shared):
    """(_k, y, at, x): places and weights of each bag's listed terms; bags without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found = [m.weighed(t.values.to_numpy(), n.values.to_numpy()) for t, n in zip(batch.column(2), batch.column(3), strict=True)]
            some = pa.array([i for i, (at, _) in enumerate(found) if len(at)], pa.int32())
            lists = [pa.array([f[k].astype(kind) for f in found if len(f[0])], pa.list_(pa.from_numpy_dtype(kind))) for k, kind in ((0, np.int32), (1, np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(some), batch.column(1).take(some), *lists], ["_k", "y", "at", "x"])

    return run


def _left_out(shared):
    """(y, share) of numbered examples: each one's share of votes from the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        place = np.argsort(m.order)
        for batch in batches:
            at, x = ([v.values.to_numpy() for v in batch.column(c)] for c in ("at", "x"))
            own = np.repeat(np.arange(batch.num_rows), [len(v) for v in at])
            cat = lambda parts, none: np.concatenate([np.zeros(0, none), *parts])
            found = m.each(own, cat(at, np.int64).astype(np.int64), cat(x, float), batch.num_rows, place[batch.column("_e").to_numpy()])
            yield pa.RecordBatch.from_arrays([batch.column("y").cast(pa.float64()), pa.array([m.voted(e, cos) for e, cos in found], pa.float64())], ["y", "share"])

    return run


def _bare(shared):
    """Labels of the documents without any listed term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for w in each_chunk(batch.column(0), NOT_LETTER, lower=True, limit=BYTES):
                m = w.last - w.first
                some = np.flatnonzero(np.bincount(shared.value.index.of(w)[0], minlength=m) == 0)
                yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(some + at))], ["y"])
                at += m

    return run


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    most_labels: int = 40_000, most_examples: int = 2000, most_terms: int = 4_000_000, k: int = 15,
) -> Examples:
    """Examples from labelled documents (labels: key and label, 0 or 1; other values and nulls are ignored).

    most_labels bounds the labels used, those with the smallest key hashes, so that they can be broadcast to the texts.
    most_examples bounds the examples of each label, those with the smallest key hashes that hold any letter, and most_terms
    their different terms in all, so that a few very long ones can't make the model large; each stands for its share of the
    labelled ones.
    Terms are runs of letters, A-Z in lower case, and the runs' first 4 to 8 bytes. All terms of the examples make the
    vectors: (1 + log of the count in the text) x idf over all documents x root of chi-square over the labelled ones. So a
    term weighs nothing only where its part of toxic and of other documents is the same, as when all of them hold it.
    Documents without weighing terms get the toxic share of labelled documents without them; all others get the share of
    their nearest examples' votes, put through a logistic curve that is fitted on the examples, each scored by the others.
    Keys are of any type. Rows that repeat a key count once each, but one of them (of the least text) is an example, so that
    none votes for itself; a key with labels 0 and 1 is 1. Null texts are empty. An empty table, or labels of one kind only,
    give a model without examples, whose score is the share of toxic labels.
    The examples' texts and bags stay in written tables; what comes to the driver is their different terms, a count of each,
    and the weighed postings.
    """
    context = docs.sparkSession.sparkContext
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.col(label).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("_k"), "_k", "y").limit(most_labels).groupBy("_k").agg(F.max("y").alias("y"))  # bounded by most_labels
    texts = docs.select(F.col(key).alias("_k"), F.col(text).alias("text"))
    labelled = staged(texts.join(F.broadcast(known), "_k").select("_k", "text", "y"), "labelled")
    n = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    ones, zeros = n.get(1, 0), n.get(0, 0)
    base = (ones + 0.5) / (ones + zeros + 1)
    nothing = Examples(TermIndex(np.zeros(0, np.int64)), np.zeros(0), [], base, 1.0, k)
    if not ones or not zeros:
        release(labelled)
        return nothing
    kind = docs.schema[key].dataType.simpleString()
    lettered = labelled.where(F.col("text").rlike(r"[A-Za-z]|[^\x00-\x7F]"))
    of = lambda y: lettered.where(F.col("y") == y).orderBy(F.xxhash64("_k"), "_k", F.xxhash64("text")).limit(most_examples)
    chosen = of(0).unionByName(of(1)).groupBy("_k", "y").agg(F.min("text").alias("text")).select("_k", "text", "y")  # bounded by most_examples
    drawn = staged(chosen.mapInArrow(_bags, f"_k {kind}, y int, terms array<long>, n array<int>").repartition(16), "bags")
    so_far = F.sum(F.size("terms")).over(Window.partitionBy("y").orderBy(F.xxhash64("_k"), "_k"))  # at most most_examples rows a label
    within = drawn.select("_k", "y", F.size("terms").alias("m"), so_far.alias("sum")).where((F.col("sum") <= most_terms) | (F.col("sum") == F.col("m")))
    held = drawn.join(F.broadcast(within.select("_k", "y")), ["_k", "y"]).select("_k", "y", "terms", "n")
    terms = distinct(held.select("terms").mapInArrow(_terms_of, "term long").distinct().toArrow()["term"].to_numpy())
    if not len(terms):
        release(drawn, labelled)
        return nothing
    m = len(terms)
    shared = context.broadcast(TermIndex(terms))
    a, b, every = (np.zeros(m + 1) for _ in range(3))
    counted = labelled.select("text", "y").mapInArrow(_counts(shared, True), "at int, ones long, zeros long").groupBy("at").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).toArrow()  # one a term
    a[counted["at"].to_numpy()], b[counted["at"].to_numpy()] = counted["ones"].to_numpy(), counted["zeros"].to_numpy()
    counted = texts.select("text").mapInArrow(_counts(shared, False), "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # one a term
    every[counted["at"].to_numpy()] = counted["n"].to_numpy()
    rows, a, b, every = every[m], a[:m], b[:m], every[:m]
    c, d = ones - a, zeros - b
    chi = (a * d - b * c) ** 2 * (ones + zeros) / np.maximum((a + b) * (c + d) * ones * zeros, 1e-9)
    weights = np.log((rows + 1) / (every + 0.5)) * np.sqrt(chi)
    index, weights = TermIndex(terms[weights > 0]), weights[weights > 0]
    shared.destroy()
    del terms, counted, a, b, c, d, every, chi
    if not index.width:
        release(drawn, labelled)
        return nothing
    shared = context.broadcast(Examples(index, weights, [], 0.0, 1.0, k))
    bare = {r["y"]: r["count"] for r in labelled.select("text", "y").mapInArrow(_bare(shared), "y int").groupBy("y").count().collect()}
    empty = (bare.get(1, 0) + base) / (sum(bare.values()) + 1)
    weighed = held.mapInArrow(_weighed(shared), f"_k {kind}, y int, at array<int>, x array<float>")
    weighed = staged(weighed.withColumn("_e", F.row_number().over(Window.orderBy("y", F.xxhash64("_k"), "_k")) - 1), "weighed")  # bounded by most_examples
    x = weighed.orderBy("_e").toArrow()
    label_of = x["y"].to_pylist()
    stands = {y: ((ones if y else zeros) - bare.get(y, 0)) / max(1, label_of.count(y)) for y in (0, 1)}
    vectors = [(key_, float(y), stands[y], at.values.to_numpy(), v.values.to_numpy()) for key_, y, at, v in zip(x["_k"].to_pylist(), label_of, x["at"], x["x"], strict=True)]
    model = Examples(index, weights, vectors, empty, 0.2, k)
    del vectors, x
    pa.default_memory_pool().release_unused()
    known = weighed.repartition(16).mapInArrow(_left_out(model.shared(docs.sparkSession)), "y double, share double").toArrow()  # bounded by most_examples
    model.calibrate(known["share"].to_numpy(), known["y"].to_numpy())
    shared.destroy()
    release(drawn, weighed, labelled)
    return model


def score(docs: DataFrame, model: Examples, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with score (0 to 1), evidence (nearest examples' keys) and cosines, in place of columns of these names.

    Null text counts as empty: no terms. Repeated rows stay, each scored. Empty table: no rows.
    """
    docs = docs.drop(*({"score", "evidence", "cosines"} - {key, text}))
    shared, slope, shift = model.shared(docs.sparkSession), model.slope, model.shift
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        m.slope, m.shift = slope, shift
        for batch in batches:
            for w in each_chunk(batch.column(text), NOT_LETTER, lower=True, limit=BYTES):
                cols = [*zip(*m.scores(*m.index.of(w), w.last - w.first), strict=True)]
                some = batch.slice(w.first, w.last - w.first)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.list_(batch.column(key).type)), pa.array(cols[2], pa.list_(pa.float64()))], [*names, "score", "evidence", "cosines"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, score double, evidence array<{docs.schema[key].dataType.simpleString()}>, cosines array<double>")


def held_out(key: str = "doc_id", parts: int = 5):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == 0, F.lit(False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLES: dict[str, str] = {}
