"""Packing tokenized documents into windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import staged

#: Words that a Python worker remembers, over all its tasks.
CACHE_WORDS = 500_000


class WordTokens(dict):
    """Token ids of words, with a bounded memory; of texts, word by word.

    The tokenizer drops white space and never joins what it separates, so a text's ids are its words' ids in turn; nor
    does it join letters with the marks behind them. Words of Latin letters alone go straight to the tokenizer's model,
    in lower case and its byte alphabet; any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        letters = [chr(c) for c in (*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100))]
        alphabet = ByteLevel(add_prefix_space=False, use_regex=False)
        self.map = {ord(c): alphabet.pre_tokenize_str(c)[0][0] for c in letters}
        self.plain = re.compile(f"([{''.join(letters)}]+)([!-/:-@\\[-`{{-~]*)").fullmatch
        self.model = self.tokenizer.model.tokenize

    def __missing__(self, w: bytes) -> bytes:
        t = w.decode()
        if (m := self.plain(t.lower())) and len(t) < 100:
            if m[2]:
                ids = self[m[1].encode()] + self[m[2].encode()]
            else:
                ids = b"".join([x.id.to_bytes(4, "little") for x in self.model(t.lower().translate(self.map))])
        else:
            ids = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        self[w] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids and the end id, as little-endian 32-bit integers."""
        if len(self) > CACHE_WORDS:
            self.clear()
        get = self.__getitem__
        return [b"".join(map(get, t.encode().split())) + self.end for t in texts]


@lru_cache(1)
def word_tokens(path: str, end_id: int) -> WordTokens:
    return WordTokens(path, end_id)


def balanced(sizes: list[int], k: int) -> list[list[int]]:
    """Indexes of sizes in k sets of near-equal sums: Karmarkar-Karp multiway differencing.

    The two partial partitions of largest imbalance are merged again and again, the largest sets of the one with the
    smallest of the other.
    """
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = s
        heap.append((-s, i, sums, [[i]], 1))
    heapq.heapify(heap)
    tick = len(sizes)
    while len(heap) > 1:
        _, _, a, sets_a, na = heapq.heappop(heap)
        _, _, b, sets_b, nb = heapq.heappop(heap)
        # sums fall; sets are kept for the first na, nb places only, the others are empty
        merged = a + b[::-1]
        sets = sets_a + [[] for _ in range(k - na)] if na < k else sets_a
        for j in range(nb):
            sets[k - 1 - j] = sets[k - 1 - j] + sets_b[j] if sets[k - 1 - j] else sets_b[j]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        n = int(np.count_nonzero(merged))
        heapq.heappush(heap, (int(merged[-1] - merged[0]), tick, merged, [sets[o] for o in order[:n].tolist()], n))
        tick += 1
    return heap[0][3] if heap else []


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """The fewest near-equal windows for sizes that differencing keeps within capacity: one more whenever it doesn't."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = balanced(sizes, k)
        if max((sum(sizes[i] for i in s) for s in sets), default=0) <= capacity:
            return sets
        k += max(1, k // 64)


OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [f.split()[0] for f in OUT.split(", ")]


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096, batch_pieces: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Documents of more than capacity tokens are cut into full windows and a rest. Of each batch of rests, Karmarkar-Karp
    differencing makes near-equal windows; their number rises whenever one would exceed capacity. Full batches are formed of
    the documents of one input partition. What a partition's last batch lacks comes from those of other partitions: their
    pieces (no ids, no texts) are dealt at random into batches of once to twice the size, so padding doesn't depend on how the
    input is split, and equal rows spread like any others. Pieces stand in a written table, so a lost task changes no window.
    Null and empty texts hold the end id alone. Repeated rows are documents of their own. Empty table: no rows.
    """
    x = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer, end_id)
        sequence = TaskContext.get().partitionId() << 40
        unplaced = -1 - sequence
        rests: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i in range(0, len(ids), 256):
                for doc, b in zip(ids[i : i + 256], tokens.encode([t or "" for t in texts.slice(i, 256).to_pylist()]), strict=True):
                    n = len(b) // 4
                    for start in range(0, n, capacity):
                        m = min(capacity, n - start)
                        piece = (doc, start, m, zlib.crc32(b[4 * start : 4 * (start + m)]), n)
                        if m == capacity:
                            out.append((*piece, sequence, 0))
                            sequence += 1
                        else:
                            rests.append(piece)
                    if len(rests) >= batch_pieces:
                        rows, sequence = _placed(rests, capacity, sequence)
                        out += rows
                        rests = []
            if out:
                yield _rows(out)
                out = []
        if rests:
            yield _rows([(*piece, unplaced - k, 0) for k, piece in enumerate(rests)])

    def join(group: tuple, rests: pa.Table) -> pa.Table:
        # a group holds under 2^24 pieces, and partitions' own sequences lie below 2^62
        columns = rests.sort_by([("sequence_id", "descending")]).columns[:5]
        rows, _ = _placed(list(zip(*(c.to_pylist() for c in columns), strict=True)), capacity, (1 << 62) + (group[0].as_py() << 24))
        return pa.Table.from_batches([_rows(rows)])

    pieces = staged(x.mapInArrow(run, OUT), "pieces")
    rests = pieces.where("sequence_id < 0")
    groups = max(1, rests.count() // batch_pieces)
    dealt = rests.select(*NAMES, F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("group"))
    joined = dealt.groupBy("group").applyInArrow(join, OUT)
    return pieces.where("sequence_id >= 0").unionByName(joined)


def _placed(pieces: list[tuple], capacity: int, sequence: int) -> tuple[list[tuple], int]:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens) with their places in windows, and the next sequence's number."""
    out = []
    for members in windows([p[2] for p in pieces], capacity):
        offset = 0
        for i in members:
            out.append((*pieces[i], sequence, offset))
            offset += pieces[i][2]
        sequence += 1
    return out, sequence


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], NAMES)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op3_packing": op3_packing}
ORACLES: dict[str, str] = {}
