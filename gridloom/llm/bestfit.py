"""Best-fit packing of tokenized documents into sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pieces import byte_texts
from .staging import release, staged

#: Tokens of texts between two batches of rows.
TOKENS = 1 << 20


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and how many of each, out of those left, that fill most of the room: bitset subset sums.

    Bit s of reach says whether some of the lengths so far sum to s. Of combinations as full, one of larger lengths.
    """
    reach, mask, before = 1, (1 << (room + 1)) - 1, []
    for n in sorted((n for n in left if n <= room), reverse=True):
        before.append((n, reach))
        many, k = min(left[n], room // n), 1
        while many:
            t = min(k, many)
            reach |= reach << n * t
            many, k = many - t, 2 * k
        reach &= mask
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for n, reach in reversed(before):
        m = 0
        while not reach >> at & 1:
            at, m = at - n, m + 1
        if m:
            out[n] = m
    return out


def combinations(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, how many of each length): sequences for all pieces by minimum bin slack.

    Each sequence takes the largest length left and the combination of the others that leaves least slack beside it. It
    stays a fullest one while there are enough pieces, so it is taken as many times as they last, without another search.
    Each time a length n falls below the m <= capacity / n that a combination needs, so there are at most the sum of
    capacity / n over all lengths n, however many pieces there are.
    """
    left, out = dict(counts), []
    while left:
        first = max(left)
        rest = {n: c - (n == first) for n, c in left.items() if c > (n == first)}
        chosen = Counter({first: 1})
        chosen.update(fullest(rest, capacity - first))
        times = min(left[n] // m for n, m in chosen.items())
        for n, m in chosen.items():
            left[n] -= times * m
            if not left[n]:
                del left[n]
        out.append((times, dict(sorted(chosen.items(), reverse=True))))
    return out


class Plan:
    """Where the r-th piece of a length goes, from the combinations; as large as these are, whatever the corpus."""

    def __init__(self, counts: dict[int, int], capacity: int):
        taken, rows, sequence = Counter(), [], 0
        for times, lengths in combinations(counts, capacity):
            offset = 0
            for n, m in lengths.items():
                rows.append((n << 50 | taken[n], taken[n], m, sequence, offset))
                taken[n] += times * m
                offset += n * m
            sequence += times
        self.sequences = sequence
        self.key, self.first, self.many, self.sequence, self.offset = np.array(sorted(rows), np.int64).reshape(-1, 5).T.copy()

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the rank-th piece of each length."""
        at = np.searchsorted(self.key, length << 50 | rank, "right") - 1
        r, m = rank - self.first[at], self.many[at]
        return self.sequence[at] + r // m, self.offset[at] + r % m * length


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, place long"
OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    columns = [*zip(*rows, strict=True)] or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, key: str, text: str) -> DataFrame:
    """Pieces of all documents, each with its task (part) and how many pieces of its length the task had before (place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seen, rows, many = byte_texts(tokenizer), TaskContext.get().partitionId(), Counter(), [], 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for doc, b in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1)), strict=True):
                b += end
                n = len(b) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for i, (a, z) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((doc, i, a, z - a, zlib.crc32(b[4 * a : 4 * z]), part, seen[z - a]))
                    seen[z - a] += 1
                if (many := many + n) > TOKENS:
                    yield _batch(rows, PIECE)
                    rows, many = [], 0
        yield _batch(rows, PIECE)

    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, PIECE)


def best_fit(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset), in as few sequences as minimum bin slack finds.

    A document of more than capacity tokens, the end id included, is cut: a first piece that may be shorter, then full ones.
    Texts aren't shuffled: pieces are written without ids, and the counts of pieces by length, at most capacity numbers, are
    all that the plan of sequences needs. A piece's number among those of its length comes from its number in its task and
    the counts of the tasks before, so no task holds all pieces of a length, and the same pieces give the same sequences.
    Null and empty texts hold the end id alone. Repeated rows and null keys are documents of their own. Empty table: no rows.
    """
    pieces = staged(cut(docs, tokenizer, end_id, capacity, key, text), "pieces")
    tasks = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    if not counts:
        release(pieces)
        return docs.sparkSession.createDataFrame([], OUT)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = tasks.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    plan = docs.sparkSession.sparkContext.broadcast(Plan(counts, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = plan.value.places(b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], [f.split()[0] for f in OUT.split(", ")])

    rank = (F.col("place") + F.col("before")).alias("rank")
    return pieces.join(before, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", rank).mapInArrow(run, OUT)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op12_best_fit": op12_best_fit}
ORACLES: dict[str, str] = {}
