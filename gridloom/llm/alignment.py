"""Alignment of two tokenizers over the same bytes by diagonal run skipping."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pieces
from .pieces import CACHE_CHARS, CACHE_WORDS, ByteTokens, KnownWords
from .staging import staged
from .words import ranges, text_bytes

#: Tokens of documents that are aligned at once, and links that are counted or looked up at once.
TOKENS, LINKS = 1 << 19, 1 << 20
#: Stands for a word whose tokens don't give its bytes back: a token of no bytes, which no vocabulary has.
WRONG = np.array([0xFFFF], "<u4").tobytes()
#: Ends that are compared at once behind a common one.
PROBE = 16
#: Words that aren't worth a text of their own, and parts of a text that isn't given back.
FEW, PARTS = 4, 16
#: Last bytes of white space of two and of three bytes in UTF-8, the last one lowest; by byte, is it white space of one byte?
_WIDE = [[int.from_bytes(c.encode(), "big") for c in map(chr, range(1 << 15)) if c.isspace() and len(c.encode()) == n] for n in (2, 3)]
_WHITE = np.array([b < 128 and chr(b).isspace() for b in range(256)])


class PieceIds:
    """Ids of a sentence-piece model, which puts a space before what it gets."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.space = self.model.piece_to_id("▁")

    def joined(self, words: list[str]) -> list[int]:
        return self.model.encode(" ".join(words))

    def of(self, word: str) -> bytes:
        return np.array(self.model.encode(word) if word else [self.space], "<u4").tobytes()

    def token_bytes(self) -> list[bytes]:
        piece = self.model.id_to_piece
        return [bytes([int(piece(i)[3:5], 16)]) if self.model.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self.model.vocab_size())]


class Sized(dict):
    """Tokens, each its id | its number of bytes << 16, of a space and a word, by the word; remembered within bounds.

    Ids and sizes fit in 16 bits each. A sentence-piece model knows no piece with a space behind another character, so it
    too tokenizes words with the spaces before them apart.
    """

    def __init__(self, ids: ByteTokens | PieceIds):
        super().__init__()
        self.ids, self.bytes = ids, ids.token_bytes()
        self.packed = np.array([i | len(b) << 16 for i, b in enumerate(self.bytes)], "<u4")

    def together(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Tokens of words of these lengths in bytes, from those of one text, and how many each has; None where these don't give its bytes back."""
        ids = self.ids.joined(words)
        if b"".join(map(self.bytes.__getitem__, ids)) != f" {' '.join(words)}".encode():
            return None
        own = self.packed[ids]
        ends, want = np.cumsum(own >> 16, dtype=np.int64), np.cumsum(lengths + 1)
        at = np.searchsorted(ends, want)
        if (ends[at] != want).any():  # a token over a space: none that these models have
            return None
        return own, np.diff(at, prepend=-1)

    def learn(self, words: list[str]) -> None:
        """Remember the words, which are new and don't end in white space, from their tokens in one text.

        Where these don't give the text's bytes back, parts of it are tried; few words are left to be looked up one by one.
        """
        if len(words) < FEW:
            return
        size = np.fromiter(map(len, words) if "".join(words).isascii() else (len(w.encode()) for w in words), np.int64, len(words))
        if (found := self.together(words, size)) is None:
            step = -(-len(words) // PARTS)
            for k in range(0, len(words), step):
                self.learn(words[k : k + step])
            return
        data, cut = found[0].tobytes(), (np.cumsum(found[1]) * 4).tolist()
        self.update(zip(words, (data[a:b] for a, b in zip([0, *cut], cut, strict=False)), strict=True))

    def __missing__(self, word: str) -> bytes:
        own = np.frombuffer(self.ids.of(word), "<u4")
        right = b"".join([self.bytes[i] for i in own.tolist()]) == f" {word}".encode()
        out = self.packed[own].tobytes() if right else WRONG
        if len(word) <= CACHE_CHARS:
            self[word] = out
        return out

    def tokens(self, words: list[str]) -> list[bytes]:
        """Tokens of each word; WRONG where these don't give it back."""
        self.learn([w for w in set(words) if w not in self and 0 < len(w) <= CACHE_CHARS and not w[-1].isspace()])
        out = [*map(self.__getitem__, words)]
        if len(self) > CACHE_WORDS:
            self.clear()
        return out


class SizedWords(KnownWords):
    """Tokens with their sizes, as Sized has them, in arrays; words that can't be told from one text come from Sized."""

    def __init__(self, tokens: Sized):
        super().__init__()
        self.tokens = tokens

    def joined(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.tokens.together(words, lengths) or self.apart(words)

    def apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokens.tokens(words)
        self.tokens.clear()  # they are remembered here
        return np.frombuffer(b"".join(found), "<u4"), np.array([len(b) // 4 for b in found], np.int64)


@lru_cache(1)
def pair_of(byte_bpe: str, piece_bpe: str) -> tuple[Sized, Sized]:
    """Both tokenizers, once for each worker."""
    return Sized(ByteTokens(byte_bpe, plain=True)), Sized(PieceIds(piece_bpe))


@lru_cache(1)
def words_of(byte_bpe: str, piece_bpe: str) -> tuple[SizedWords, SizedWords]:
    """The words that a worker remembers of each."""
    first, second = pair_of(byte_bpe, piece_bpe)
    return SizedWords(first), SizedWords(second)


def cut(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of all texts, none of them null or empty, each with the space before it, and where those of each text begin and end.

    A word begins with a space put before the text, and with each space behind a character that is no white space. Words
    stay where they stand in the texts.
    """
    data, offsets = text_bytes(pc.binary_join_element_wise("", texts.cast(pa.string()), " "))
    spaces = np.flatnonzero(data == 32)
    before = data[spaces - 1]
    begins = ~_WHITE[before]
    wide = np.flatnonzero(before >= 128)
    last = sum(data[spaces[wide] - k - 1].astype(np.int64) << 8 * k for k in range(3))
    begins[wide] = ~(np.isin(last & 0xFFFF, _WIDE[0]) | np.isin(last, _WIDE[1]))
    begins[np.searchsorted(spaces, offsets[:-1])] = True
    starts = spaces[begins]
    edges = pa.py_buffer(np.append(starts, offsets[-1]).astype(np.int32))
    return pa.Array.from_buffers(pa.string(), len(starts), [None, edges, pa.py_buffer(data)]).dictionary_encode(), np.searchsorted(starts, offsets)


def runs(a: np.ndarray | list[int], b: np.ndarray | list[int]) -> list[tuple[int, int, int]]:
    """(i, j, n) of ascending ends whose last are equal: ends i..i+n-1 of a are ends j..j+n-1 of b, and these are all common ones.

    Diagonal run skipping: from a common end on, while the shift j - i stays, probes of PROBE ends, twice as many, ... are
    compared at once by their bytes, so a one-to-one stretch of n tokens is jumped in log n steps; the first bit in which
    a probe fails tells the stretch's end. There an irregular group begins: the lesser end goes on until both meet, which
    gives the next shift.
    """
    out, i, j, n = [], 0, 0, len(a)
    ends = [np.append(np.asarray(x, "<u4"), np.uint32(last)) for x, last in ((a, 0xFFFFFFFF), (b, 0xFFFFFFFE))]  # no probe goes on behind the end
    (a, b), (of_a, of_b) = map(memoryview, ends), (x.tobytes() for x in ends)
    number = int.from_bytes
    while i < n:
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        p, q, size = 4 * i, 4 * j, 4 * PROBE
        while (u := of_a[p : p + size]) == (v := of_b[q : q + size]):
            p, q, size = p + size, q + size, 2 * size
        differ = number(u, "little") ^ number(v, "little")
        k = (p >> 2) - i + ((differ & -differ).bit_length() - 1 >> 5)
        out.append((i, j, k))
        i, j = i + k, j + k
    return out


def groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups of two token sequences of one text end: the places of their last tokens in each."""
    at = np.array(runs(np.cumsum(a >> 16, dtype="<u4"), np.cumsum(b >> 16, dtype="<u4")), np.int64).reshape(-1, 3)
    i, j, n = at.T
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(i, n) + within, np.repeat(j, n) + within


@lru_cache(1)
def _cells() -> np.ndarray:
    """By kind of mark (comma, bar, semicolon) << 16 | number: the number's decimal digits and the mark, in the first bytes of eight."""
    return np.array([f"{n}{mark}" for mark in ",|;" for n in range(1 << 16)], "S8").view("<u8")


def written(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Groups as text: ids of the first with commas, a bar, ids of the second with commas, a semicolon; eight bytes a token, unused ones 0."""
    of_a, of_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
    at_a = np.arange(len(a)) + np.repeat(j + 1 - of_b, of_a)  # before a group stand all tokens of both in earlier ones
    at_b = np.arange(len(b)) + np.repeat(i + 1, of_b)
    ids = np.empty(len(a) + len(b), np.int64)
    ids[at_a], ids[at_b] = a & 0xFFFF, b & 0xFFFF
    ids[at_a[i]] |= 1 << 16
    ids[at_b[j]] |= 2 << 16
    return _cells()[ids]


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, a binary, b binary"


def _rows(docs: pa.Array, n_a=0, n_b=0, n_groups=0, digests=None, linked=(b"", b"")) -> pa.RecordBatch:
    """Rows of documents; linked ids stand one document's behind another's."""
    counts = [np.broadcast_to(np.asarray(n, np.int64), len(docs)) for n in (n_a, n_b, n_groups)]
    edges = pa.py_buffer(np.concatenate([[0], np.cumsum(counts[2] * 2)]).astype(np.int32))
    ids = [pa.Array.from_buffers(pa.binary(), len(docs), [None, edges, pa.py_buffer(x)]) for x in linked]
    return pa.RecordBatch.from_arrays([docs, *map(pa.array, counts), pa.array(digests or [""] * len(docs)), *ids], [f.split()[0] for f in ALIGNED.split(", ")])


def _slice(batch: pa.RecordBatch, first: SizedWords, second: SizedWords) -> Iterator[pa.RecordBatch]:
    """Rows of the batch's documents, those without tokens first."""
    some = pc.fill_null(pc.greater(pc.binary_length(batch.column(1)), 0), False)
    docs, none = batch.column(0).filter(some), batch.column(0).filter(pc.invert(some))
    found, words = cut(batch.column(1).filter(some))
    dictionary, places = pc.utf8_slice_codeunits(found.dictionary, 1), found.indices.to_numpy()
    sides = []
    for side in (first, second):
        at = side.learn(dictionary)
        tokens, edges = side.copied(at[places])
        side.bound(at)
        sides.append((tokens, edges[words]))
    wrong = np.unique(np.concatenate([np.searchsorted(edges, np.flatnonzero(tokens < 1 << 16), "right") - 1 for tokens, edges in sides]))
    if len(wrong):
        right = np.ones(len(docs), bool)
        right[wrong] = False
        none = pa.concat_arrays([none, docs.filter(pa.array(~right))])
        docs = docs.filter(pa.array(right))
        sides = [(tokens[np.repeat(right, np.diff(edges))], np.concatenate([[0], np.cumsum(np.diff(edges)[right])])) for tokens, edges in sides]
    if len(none):
        yield _rows(none)
    (a, of_a), (b, of_b) = sides
    for x, y in ranges(of_a + of_b, TOKENS):
        yield _block(docs[x:y], a[of_a[x] : of_a[y]], b[of_b[x] : of_b[y]], of_a[x : y + 1] - of_a[x], of_b[x : y + 1] - of_b[x])


def _block(docs: pa.Array, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> pa.RecordBatch:
    """Rows of documents whose tokens begin and end at these places; each one's end is an end of both."""
    i, j = groups(a, b)
    cells = written(a, b, i, j)
    digests = [hashlib.sha256(cells[x:y].tobytes().translate(None, b"\0")[:-1]).hexdigest() for x, y in pairwise((of_a + of_b).tolist())]
    n_groups = np.diff(np.searchsorted(i, of_a))
    return _rows(docs, np.diff(of_a), np.diff(of_b), n_groups, digests, (a[i].astype("<u2"), b[j].astype("<u2")))


def aligned(docs: DataFrame, byte_bpe: str, piece_bpe: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, a, b): each document's groups; a and b hold the ids that are linked, two bytes each, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            for x, y in ranges(np.concatenate([[0], size]), pieces.SLICE):
                yield from _slice(batch.slice(x, y - x), *words_of(byte_bpe, piece_bpe))

    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, ALIGNED)


def _links(batch: pa.RecordBatch) -> tuple[Iterator[np.ndarray], np.ndarray]:
    """Linked ids a | b << 16 of the batch's documents, LINKS at a time, and where each document's begin and end."""
    parts = []
    for name in ("a", "b"):
        column = batch.column(name).cast(pa.large_binary())
        at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // 2
        data = column.buffers()[2]
        parts.append(np.frombuffer(data, "<u2")[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, "<u2"))
    a, b = parts
    steps = (slice(k, k + LINKS) for k in range(0, len(a), LINKS))
    return (a[k].astype(np.uint32) | b[k].astype(np.uint32) << np.uint32(16) for k in steps), at - at[0]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n) of the partition's links."""
    pairs, n, waiting = np.zeros(0, np.uint32), np.zeros(0, np.int64), []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        u, back = np.unique(np.concatenate([pairs, *(w[0] for w in waiting)]), return_inverse=True)
        total = np.zeros(len(u), np.int64)
        np.add.at(total, back, np.concatenate([n, *(w[1] for w in waiting)]))
        waiting.clear()
        return u, total

    for batch in batches:
        for links in _links(batch)[0]:
            waiting.append(np.unique(links, return_counts=True))
            if sum(len(w[0]) for w in waiting) > max(LINKS, len(pairs)):
                pairs, n = merged()
    pairs, n = merged()
    yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n)], ["pair", "n"])


def _looked_up(batch: pa.RecordBatch, pairs: np.ndarray, n: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    """Rows of the batch's documents with the sums over their links; pairs are in order, with the count of each and whether it is its b's highest."""
    steps, at = _links(batch)
    sums, done = np.zeros((2, len(at)), np.int64), 0  # over all links before each place
    before = [0, 0]
    for links in steps:
        found = np.searchsorted(pairs, links)
        x, y = np.searchsorted(at, (done, done + len(links)), "right")
        for k, of in enumerate((best, n)):
            so_far = np.cumsum(of[found], dtype=np.int64)
            sums[k, x:y] = before[k] + so_far[at[x:y] - done - 1]
            before[k] += int(so_far[-1])
        done += len(links)
    per = [pa.array(np.diff(x)) for x in (at, *sums)]
    return pa.RecordBatch.from_arrays([*batch.columns[:4], *per, batch.column("groups_sha256")], [f.split()[0] for f in OUT.split(", ")])


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, byte_bpe: str, piece_bpe: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): tokens of a byte-level BPE (a) and of a
    sentence-piece model (b) of each document, aligned by their bytes.

    Byte offsets where tokens of both end cut them into groups, and the last tokens of a group are linked. Every token has
    bytes, so a document has as many links as groups. How often two ids are linked is counted over all documents; of linked
    ids one's bytes end in the other's, so there are no more pairs than the tokens of both vocabularies have bytes (twice as
    many where bytes have pieces of their own), whatever the corpus: under a million, which are broadcast. Null and empty
    texts, and texts that one of the tokenizers doesn't give back, have no tokens. Repeated rows count each. Null keys stay.
    Empty table: no rows.
    """
    done = staged(aligned(docs, byte_bpe, piece_bpe, key, text), "aligned", "zstd")
    counts = done.select("a", "b").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # bounded by the vocabularies
    pairs = counts["pair"].to_numpy()
    order = np.argsort(pairs)
    pairs, n = pairs[order].astype(np.uint32), counts["n"].to_numpy()[order]
    most = np.zeros(1 << 16, np.int64)
    np.maximum.at(most, pairs >> np.uint32(16), n)
    shared = docs.sparkSession.sparkContext.broadcast((pairs, n, n == most[pairs >> np.uint32(16)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _looked_up(batch, *shared.value)

    return done.select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "a", "b").mapInArrow(run, OUT)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op11_alignment": op11_alignment}
ORACLES: dict[str, str] = {}
