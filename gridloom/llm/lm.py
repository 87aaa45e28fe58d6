"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) P(word | class). The classes' softmax has a weight for each hashed feature of
the history (previous word, previous two, and words skipped to) and class; a class's words have a softmax of
their smoothed counts. Classes gather the commonest words that stand beside alike words; all others, and those never
seen, are the last class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import staged
from .words import SPACE, each_chunk, mix, signed

END = np.uint64(0x6C62272E07BB0142)
SMOOTH = 0.1
#: Tokens of one gradient step.
STEP = 8192


@dataclass(frozen=True)
class Model:
    """Head words, classes and feature buckets; as many words and buckets as grown() tells for the training tokens."""

    keys: np.ndarray  # hashes of head words by slot, each in the first free one from its own on
    counts: np.ndarray  # their counts by slot
    cls: np.ndarray  # their classes by slot
    mass: np.ndarray  # smoothed mass of each class; the last is that of all other words
    total: int
    distinct: int
    bias: np.ndarray
    weights: np.ndarray  # feature bucket x class

    @property
    def slot_shift(self) -> np.uint64:
        return np.uint64(64 - int(len(self.keys)).bit_length() + 1)

    def slots(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each word, and whether it is a head word."""
        s = (h >> self.slot_shift).astype(np.int64)
        known, taken = self.keys[s] == h, self.counts[s] > 0
        known &= taken
        left = np.flatnonzero(taken & ~known)
        while len(left):
            s[left] = (s[left] + 1) % len(self.keys)
            hit, taken = self.keys[s[left]] == h[left], self.counts[s[left]] > 0
            known[left[hit & taken]] = True
            left = left[taken & ~hit]
        return s, known

    def features(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Buckets of the four features of each token; first: where documents begin. Histories don't cross documents."""
        n, size = len(h), np.uint64(len(self.weights))
        age = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        back = []
        for k in (1, 2, 3):
            x = np.zeros(n, np.uint64)
            x[k:] = h[:-k] if n > k else h[:0]
            x[age < k] = 0
            back.append(x)
        one, two, three = back
        marks = [one, one * np.uint64(0x9E3779B97F4A7C15) + two, two, three]
        return np.stack([mix(m + np.uint64(k * 0x1000193 + 1)) % size for k, m in enumerate(marks)]).astype(np.uint16 if size <= 1 << 16 else np.uint32)

    def log_classes(self, f: np.ndarray) -> np.ndarray:
        """Natural logs of the classes' probabilities, by token."""
        z = self.bias + self.weights[f[0]]
        for k in range(1, len(f)):
            z += self.weights[f[k]]
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, last, hashes of words and ends, where documents begin) of chunks of a text column."""
    for w in each_chunk(column, SPACE, lower=True, limit=1 << 19):
        m = w.last - w.first
        first = w.at[:-1] + np.arange(m)
        h = np.insert(w.hash, w.at[1:], END)
        yield w.first, w.last, h, first


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of training documents, one row for each word and batch."""
    for batch in batches:
        parts = [np.unique(h, return_counts=True) for _, _, h, _ in tokens(batch.column(0))]
        if parts:
            words, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(words)), pa.array(n)], ["word", "n"])


def _bias(mass: np.ndarray) -> np.ndarray:
    """Logs of the classes' shares; a class without words is never asked for, and gets no share to speak of."""
    return np.where(mass <= 0, -30.0, np.log(np.maximum(mass, 1e-9) / max(mass.sum(), 1e-9))).astype(np.float32)


def grown(tokens: int) -> int:
    """Head words and feature buckets for so many training tokens: the power of two next to 8192 and the tokens' root."""
    return 1 << round(float(np.log2(8192 + tokens**0.5)))


def _slotted(words: np.ndarray, bits: int) -> np.ndarray:
    """A slot for each word: its own by its first bits, or the first free one behind."""
    slot, taken = (words >> np.uint64(64 - bits)).astype(np.int64), np.zeros(1 << bits, bool)
    left = np.arange(len(words))
    while len(left):
        first = np.zeros(len(left), bool)
        first[np.unique(slot[left], return_index=True)[1]] = True
        first &= ~taken[slot[left]]
        taken[slot[left[first]]] = True
        left = left[~first]
        slot[left] = (slot[left] + 1) % len(taken)
    return slot


def _head(counts: DataFrame, head_words: int | None, slot_bits: int | None, classes: int, buckets: int | None) -> Model:
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    total, distinct = total or 0, distinct or 0
    head_words, buckets = head_words or grown(total), buckets or grown(total)
    slot_bits = slot_bits or (4 * head_words - 1).bit_length()
    top = counts.orderBy(F.desc("n"), "word").limit(head_words).toArrow()  # bounded by head_words
    keys, n, cls = np.zeros(1 << slot_bits, np.uint64), np.zeros(1 << slot_bits, np.int64), np.full(1 << slot_bits, classes - 1, np.int8)
    words, count = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy()
    slot = _slotted(words, slot_bits)
    keys[slot], n[slot] = words, count
    share = np.cumsum(count) - count / 2
    own = np.minimum((share / max(1, count.sum()) * (classes - 1)).astype(np.int8), classes - 2)
    cls[slot] = own
    mass = np.bincount(own, count + SMOOTH, classes).astype(float)
    mass[-1] = total - count.sum() + SMOOTH * (distinct - len(words) + 1)
    return Model(keys, n, cls, mass, int(total), int(distinct), _bias(mass), np.zeros((buckets, classes), np.float32))


def _contexts(shared):
    """How often a class stands before and behind each head word: (word's place x 2 classes + class, n), by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        classes, own = len(m.bias), np.flatnonzero(m.counts)
        place = np.full(len(m.keys), -1)
        place[own] = np.arange(len(own))
        sums, cells, held = np.zeros(len(own) * 2 * classes, np.int64), [], 0
        for batch in batches:
            for _, _, h, first in tokens(batch.column(0)):
                s, known = m.slots(h)
                y = np.where(known, m.cls[s], classes - 1).astype(np.int64)
                before, behind = np.roll(y, 1), np.roll(y, -1)
                before[first] = behind[first[1:] - 1] = behind[-1] = classes - 1
                k = np.flatnonzero(known)
                base = place[s[k]] * 2 * classes
                cells += [base + before[k], base + classes + behind[k]]
                held += 2 * len(k)
                if held > 1 << 21:
                    sums += np.bincount(np.concatenate(cells), minlength=len(sums))
                    cells, held = [], 0
        if cells:
            sums += np.bincount(np.concatenate(cells), minlength=len(sums))
        some = np.flatnonzero(sums)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["cell", "n"])

    return run


def _classed(model: Model, contexts: np.ndarray, rounds: int = 15) -> Model:
    """The model with classes by k-means of its head words' contexts, weighted by the words' counts."""
    own, classes = np.flatnonzero(model.counts), len(model.bias)
    if len(own) < classes:
        return model
    count, rng = model.counts[own].astype(np.float64), np.random.default_rng(1)
    x = contexts.reshape(len(own), -1) + 0.2
    x = np.sqrt(2 * x / x.sum(1, keepdims=True))
    centre = x[rng.choice(len(own), classes - 1, replace=False, p=count / count.sum())]
    for _ in range(rounds):
        cls = ((centre**2).sum(1) - 2 * x @ centre.T).argmin(1)
        for c in np.unique(cls):
            weight = np.sqrt(count[cls == c])
            centre[c] = weight @ x[cls == c] / weight.sum()
    by_slot = np.full(len(model.keys), classes - 1, np.int8)
    by_slot[own] = cls
    mass = np.bincount(cls, count + SMOOTH, classes)
    mass[-1] = model.mass[-1]
    return replace(model, cls=by_slot, mass=mass, bias=_bias(mass))


def _train(shared, rate: float):
    """Gradient steps over the documents of one partition, from shared weights: its weights by feature bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        m = replace(m, weights=m.weights.copy())
        w, seen, classes = m.weights, np.zeros(len(m.weights), np.int64), m.weights.shape[1]
        power = np.full(len(w), 1e-3, np.float32)
        for batch in batches:
            for _, _, h, first in tokens(batch.column(0)):
                s, known = m.slots(h)
                y = np.where(known, m.cls[s], classes - 1)
                feats = m.features(h, first)
                for i in range(0, len(h), STEP):
                    f, target = feats[:, i : i + STEP], y[i : i + STEP]
                    g = np.exp(m.log_classes(f))
                    g[np.arange(len(target)), target] -= 1
                    for k in range(len(f)):
                        order = np.argsort(f[k], kind="stable")  # by radix, as buckets have 16 bits
                        own = f[k][order]
                        at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                        rows, sums = own[at], np.add.reduceat(g[order], at)
                        power[rows] += (sums * sums).mean(1)
                        w[rows] -= (rate / np.sqrt(power[rows]))[:, None] * sums
                        seen[rows] += np.diff(np.append(at, len(own)))
        rows = np.flatnonzero(seen)
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(seen[rows]), *(pa.array(w[rows, c].astype(np.float64)) for c in range(classes))], ["bucket", "n", *(f"w{c}" for c in range(classes))])

    return run


def fit(docs: DataFrame, text: str = "text", head_words: int | None = None, slot_bits: int | None = None, classes: int = 16, buckets: int | None = None, rounds: int = 1, rate: float = 0.1) -> tuple[Model, DataFrame]:
    """The model of all given documents, and their words' counts (word, n).

    Counts are of all documents, added up before and after one shuffle; so are the contexts of head words, by which
    these are classed. In each round every partition makes gradient
    steps over all its documents from the same weights, and the partitions' weights are averaged by how often each saw a
    feature, so the weights depend a little on how the input is split. Only the commonest head_words words, their contexts
    and buckets x classes sums come to the driver. head_words and buckets grow with the root of the input's tokens (grown),
    so that a partition's weights stay small beside its documents; counts of all words grow
    with them and stay a table. Null texts are an end alone; repeated rows count each; extra columns are left out; an empty
    table gives a model of total 0.
    """
    spark, some = docs.sparkSession, docs.select(text)
    counts = staged(some.mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    model = _head(counts, head_words, slot_bits, classes, buckets)
    names = [f"w{c}" for c in range(classes)]
    if model.total:
        cells = some.mapInArrow(_contexts(spark.sparkContext.broadcast(model)), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # head_words x 2 classes
        contexts = np.zeros(np.count_nonzero(model.counts) * 2 * classes)
        contexts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
        model = _classed(model, contexts)
    for _ in range(rounds if model.total else 0):
        shared = spark.sparkContext.broadcast(model)
        parts = some.mapInArrow(_train(shared, rate), "bucket long, n long, " + ", ".join(f"{c} double" for c in names))
        rows = parts.groupBy("bucket").agg(*((F.sum(F.col("n") * F.col(c)) / F.sum("n")).cast("float").alias(c) for c in names)).collect()  # one a bucket
        weights = model.weights.copy()
        weights[[r[0] for r in rows]] = np.array([r[1:] for r in rows], np.float32)
        model = replace(model, weights=weights)
        shared.unpersist()
    return model, counts


SCORED = "n_tokens long, head_known long, head_log double, class_log double, tail_words array<long>, tail_times array<int>"


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        classes = m.weights.shape[1]
        log_mass = np.log10(np.maximum(m.mass, 1e-300))
        for batch in batches:
            for lo, hi, h, first in tokens(batch.column(1)):
                s, known = m.slots(h)
                y = np.where(known, m.cls[s], classes - 1)
                feats = m.features(h, first)
                cls = np.concatenate([np.take_along_axis(m.log_classes(feats[:, i : i + STEP]), y[i : i + STEP, None].astype(np.int64), 1)[:, 0] for i in range(0, len(h), STEP)])
                head = np.where(known, np.log10(m.counts[s] + SMOOTH), 0.0)
                sums = lambda x: np.add.reduceat(x, first)
                tails, times = [], []
                for a, b in zip(first, np.append(first[1:], len(h)), strict=True):
                    t, n = np.unique(signed(h[a:b][~known[a:b]]), return_counts=True)
                    tails.append(t)
                    times.append(n.astype(np.int32))
                at = pa.array(np.cumsum([0, *map(len, tails)], dtype=np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x))) for x in (tails, times)]
                # class_log: log10 of class, and of 1 / the class's mass
                within = cls.astype(np.float64) / np.log(10) - log_mass[y]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(np.append(first, len(h)))), pa.array(sums(known.astype(np.int64))), pa.array(sums(head)), pa.array(sums(within)), *lists], ["doc", *(x.split()[0] for x in SCORED.split(", "))])

    return run


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) for every row; null text: the end alone.

    Head words' counts are in the model; counts of all other words, of which none is common, are joined by word.
    Repeated rows are scored each on its own. Null keys stay. Empty table: no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    rows = staged(docs.select(key, text).mapInArrow(_score(shared), f"doc {kind}, {SCORED}").withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = rows.select("row", F.explode(F.arrays_zip("tail_words", "tail_times")).alias("t")).select("row", F.col("t.tail_words").alias("word"), F.col("t.tail_times").alias("times"))
    tail = tail.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("tail_log"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known")
    )
    out = rows.drop("tail_words", "tail_times").join(tail, "row", "left")
    tail_log, known = F.coalesce("tail_log", F.lit(0.0)), F.col("head_known") + F.coalesce("tail_known", F.lit(0))
    norm = float(np.log10(model.total + SMOOTH * (model.distinct + 1)))
    return out.select(
        F.col("doc").alias(key), "n_tokens", known.alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log - F.col("n_tokens") * norm).alias("base_score"), (F.col("head_log") + tail_log + F.col("class_log")).alias("score"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    model, counts = fit(docs.where(~held))
    return score(docs, model, counts).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
ORACLES: dict[str, str] = {}
