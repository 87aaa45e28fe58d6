"""Media columns: signatures are found by Aho-Corasick, then confirmed by the format's own structure."""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Formats and their magic bytes. Fixed values.
MAGIC = {
    "image/png": b"\x89PNG\r\n\x1a\n",
    "image/gif": b"GIF8",
    "image/jpeg": b"\xff\xd8\xff",
    "image/bmp": b"BM",
    "riff": b"RIFF",
    "application/pdf": b"%PDF-",
    "application/zip": b"PK\x03\x04",
    "application/gzip": b"\x1f\x8b\x08",
    "audio/flac": b"fLaC",
    "audio/ogg": b"OggS",
}
#: What ends a PDF, and a ZIP archive's directory. Fixed values.
ENDS = {"eof": b"%%EOF", "startxref": b"startxref", "directory": b"PK\x05\x06"}


class Seen:
    """What one pass over a payload found: where ends begin, and where chains of sub-blocks lead."""

    def __init__(self) -> None:
        self.ends: dict[str, list[int]] = {k: [] for k in ENDS}
        self.chains: dict[int, int] = {}
        self.pages: dict[int, int | None] = {}  # where the pages from a place on end; None: nowhere
        self.pictures: dict[int, int | None] = {}  # and the blocks of pictures
        self.chunks: dict[tuple[int, int], frozenset[bytes] | None] = {}  # from a place to an end: which chunks that count; None: they miss it

    def next(self, kind: str, i: int) -> int:
        """The first end of this kind from i on, or -1."""
        at = self.ends[kind]
        k = bisect_left(at, i)
        return at[k] if k < len(at) else -1

    def chain(self, b: bytes, p: int) -> int:
        """Behind the sub-blocks (a length, then so many bytes) from p on; steps that were taken before aren't again."""
        path = []
        while p not in self.chains and p < len(b) and b[p]:
            path.append(p)
            p += 1 + b[p]
        end = self.chains.get(p, p + 1)
        for q in path:
            self.chains[q] = end
        return end


def _png(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    p, first = i + 8, True
    while p + 12 <= len(b):
        n, kind = int.from_bytes(b[p : p + 4], "big"), b[p + 4 : p + 8]
        end = p + 12 + n
        if end > len(b) or first and (kind != b"IHDR" or n != 13) or zlib.crc32(b[p + 4 : end - 4]) != int.from_bytes(b[end - 4 : end], "big"):
            return None
        if kind == b"IEND":
            return "image/png", end
        p, first = end, False
    return None


def _gif(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    if b[i + 4 : i + 6] not in (b"7a", b"9a") or i + 13 > len(b):
        return None
    table = lambda flags: 3 << ((flags & 7) + 1) if flags & 0x80 else 0
    p, path, end = i + 13 + table(b[i + 10]), [], None
    while p < len(b):
        if p in seen.pictures:
            end = seen.pictures[p]
            break
        path.append(p)
        if b[p] == 0x3B:
            end = p + 1
            break
        if b[p] == 0x21:
            p = seen.chain(b, p + 2)
        elif b[p] == 0x2C and p + 10 <= len(b):
            p = seen.chain(b, p + 10 + table(b[p + 9]) + 1)
        else:
            break
    seen.pictures.update(dict.fromkeys(path, end))
    return ("image/gif", end) if end else None


def _jpeg(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    p = i + 2
    while p + 4 <= len(b) and b[p] == 0xFF:
        marker = b[p + 1]
        if marker == 0xD9:
            return "image/jpeg", p + 2
        n = int.from_bytes(b[p + 2 : p + 4], "big")
        if n < 2:
            return None
        p += 2 + n
        if marker == 0xDA:  # coded data: up to the next marker that is neither an escape nor a restart
            while 0 <= (p := b.find(b"\xff", p)) and p + 1 < len(b) and (b[p + 1] == 0 or 0xD0 <= b[p + 1] <= 0xD7):
                p += 2
            if p < 0:
                return None
    return ("image/jpeg", p + 2) if b[p : p + 2] == b"\xff\xd9" else None


def _bmp(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    if i + 54 > len(b):
        return None
    size, reserved, offset, header, _, _, planes, depth = struct.unpack_from("<IIIIiiHH", b, i + 2)
    ok = reserved == 0 and planes == 1 and depth in (1, 4, 8, 16, 24, 32) and header in (40, 52, 56, 108, 124) and 14 + header <= offset <= size <= len(b) - i
    return ("image/bmp", i + size) if ok else None


def _riff(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    if i + 12 > len(b):
        return None
    end = i + 8 + int.from_bytes(b[i + 4 : i + 8], "little")
    kind = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/avi"}.get(b[i + 8 : i + 12])
    p, path = i + 12, []
    if kind is None or end > len(b):
        return None
    while p + 8 <= end and (p, end) not in seen.chunks:
        path.append(p)
        n = int.from_bytes(b[p + 4 : p + 8], "little")
        p += 8 + n + n % 2
    names = seen.chunks.get((p, end), frozenset() if p == end else None)
    for q in reversed(path):
        names = None if names is None else names | ({b[q : q + 4]} & {b"fmt ", b"data"})
        seen.chunks[q, end] = names
    return (kind, end) if names is not None and (kind != "audio/wav" or len(names) == 2) else None


def _pdf(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    end, index = seen.next("eof", i), seen.next("startxref", i)
    return ("application/pdf", end + 5) if b[i + 5 : i + 6].isdigit() and 0 < index < end else None


def _zip(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    p = seen.next("directory", i)
    if p < 0 or p + 22 > len(b):
        return None
    size, offset, comment = struct.unpack_from("<IIH", b, p + 12)
    return ("application/zip", p + 22 + comment) if i + offset + size == p and p + 22 + comment <= len(b) and b[i + offset : i + offset + 4] == b"PK\x01\x02" else None


def _gzip(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    try:
        inflate, p = zlib.decompressobj(31), i
        while p < len(b) and not inflate.eof:  # inflated a piece at a time, so that no long text is held
            inflate.decompress(b[p : p + 4096])
            p += 4096
        return ("application/gzip", min(p, len(b)) - len(inflate.unused_data)) if inflate.eof else None
    except zlib.error:
        return None


def _flac(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    return ("audio/flac", len(b)) if b[i + 4 : i + 5] in (b"\x00", b"\x80") and b[i + 5 : i + 8] == b"\x00\x00\x22" and i + 42 <= len(b) else None


def _ogg(b: bytes, i: int, seen: Seen) -> tuple[str, int] | None:
    p, path, end = i, [], None
    while b[p : p + 4] == b"OggS" and p + 27 <= len(b):
        if p in seen.pages:
            end = seen.pages[p]
            break
        path.append(p)
        after, last = p + 27 + b[p + 26] + sum(b[p + 27 : p + 27 + b[p + 26]]), b[p + 5] & 4
        if after > len(b) or last:
            end = after if after <= len(b) else None
            break
        p = after
    seen.pages.update(dict.fromkeys(path, end))
    return ("audio/ogg", end) if end else None


VALID: dict[str, Callable[[bytes, int, Seen], tuple[str, int] | None]] = {
    "image/png": _png, "image/gif": _gif, "image/jpeg": _jpeg, "image/bmp": _bmp, "riff": _riff,
    "application/pdf": _pdf, "application/zip": _zip, "application/gzip": _gzip, "audio/flac": _flac, "audio/ogg": _ogg,
}


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    """Of all magic bytes and ends, one character a byte."""
    a = ahocorasick.Automaton()
    for kind, magic in {**MAGIC, **ENDS}.items():
        a.add_word(magic.decode("latin-1"), (kind, len(magic)))
    a.make_automaton()
    return a


def found_media(b: bytes) -> list[tuple[str, int, int]]:
    """(type, start, end) of all media whose structure holds, by start; what lies inside raw samples counts too."""
    seen, starts = Seen(), []
    for last, (kind, n) in automaton().iter(b.decode("latin-1")):
        (seen.ends[kind] if kind in ENDS else starts).append(last - n + 1 if kind in ENDS else (last - n + 1, kind))
    hits = ((i, VALID[kind](b, i, seen)) for i, kind in starts)
    return sorted(((hit[0], i, hit[1]) for i, hit in hits if hit), key=lambda x: x[1])


SNIFFED = "sniffed_type string, media_end long, embedded array<struct<type: string, start: long, end: long>>"


def sniff(df: DataFrame, content: str, declared: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add sniffed_type, media_end, embedded and (with declared) corrected to a table of bytes.

    sniffed_type: the format confirmed at byte 0, else application/octet-stream (also for null and empty contents).
    media_end: its length by its own structure (null without one). embedded: all other media confirmed inside.
    corrected: does the declared type differ from the sniffed one (null counts as different)? keep: columns to carry
    along, all by default; contents pass through unchanged. An empty table gives no rows.
    """
    keep = df.columns if keep is None else keep
    base = df.select(*dict.fromkeys([*keep, content]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kinds, ends, inner = [], [], []
            for b in batch.column(content).to_pylist():
                found = found_media(b or b"")
                own = next((x for x in found if x[1] == 0), None)
                kinds.append(own[0] if own else "application/octet-stream")
                ends.append(own[2] if own else None)
                inner.append([{"type": k, "start": s, "end": e} for k, s, e in found if s])
            kind = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kinds, pa.string()), pa.array(ends, pa.int64()), pa.array(inner, kind)], [*batch.schema.names, "sniffed_type", "media_end", "embedded"])

    schema = base.schema.simpleString()[7:-1]
    out = base.mapInArrow(run, f"{schema},{SNIFFED}" if schema else SNIFFED)
    return out.withColumn("corrected", ~F.col(declared).eqNullSafe(F.col("sniffed_type"))) if declared else out


def carve(df: DataFrame, content: str) -> DataFrame:
    """One row per embedded medium of a sniffed table: its columns, and type, start, end and bytes of the medium."""
    x = df.withColumn("_m", F.explode("embedded"))
    return x.select(*df.columns, F.col("_m.type").alias("carved_type"), F.col("_m.start").alias("carved_start"), F.col("_m.end").alias("carved_end"), F.expr(f"substring({content}, int(_m.start) + 1, int(_m.end - _m.start))").alias("carved"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that few contents are held at a time."""
    for batch in batches:
        for at in range(0, max(1, len(batch)), rows):
            yield batch.slice(at, rows)


def wav(payload: bytes, rate: int = 8000) -> bytes:
    """A mono WAV file of 8-bit samples."""
    n = len(payload)
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", n) + payload


def wav_samples(b: bytes) -> bytes:
    """The samples of a WAV file, found through its chunks."""
    p = 12
    while b[p : p + 4] != b"data":
        n = int.from_bytes(b[p + 4 : p + 8], "little")
        p += 8 + n + n % 2
    return b[p + 8 : p + 8 + int.from_bytes(b[p + 4 : p + 8], "little")]


DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, corrected boolean, carved array<struct<type: string, start: long, end: long, sha256: string>>"


def store_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, media): each text's UTF-8 bytes, padded with 0 to a positive multiple of 64, as 8-bit WAV samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
            media = [wav(b + b"\0" * ((-len(b) % 64) if b else 64)) for b in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], [key, "n_bytes", "media"])

    x = docs.select(key, text)
    return x.mapInArrow(run, f"{x.schema[key].simpleString().replace(':', ' ', 1)}, n_bytes long, media binary")


def digest(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """The digest columns of sniffed media: samples read back through the file's structure, and what was sniffed.

    feature: sniffed type, samples, their mean, number of sign-like crossings of the mean's level and the embedded types.
    corrected: whether the declared type was another. carved: type and place of each embedded medium, and the SHA-256 of
    its bytes; null for one that begins inside an earlier medium with a hash, so that no byte is hashed twice.
    """
    import numpy as np

    names = [key, *(x.split()[0] for x in DIGEST.split(", ") if x.split()[0] not in ("start:", "end:", "sha256:"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carved = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sha256", pa.string())]))
        for batch in slices(batches):
            rows = []
            for k, n, b, kind, inner, corrected in zip(*(batch.column(c).to_pylist() for c in (key, "n_bytes", "media", "sniffed_type", "embedded", "corrected")), strict=True):
                s = wav_samples(b)
                x = np.frombuffer(s, np.uint8)
                crossings = int(np.count_nonzero(np.diff((x >= 128).view(np.int8))))
                feature = f"{kind};n={len(s)};mean={int(x.sum())}/{len(s)};max={int(x.max())};crossings={crossings};embedded={','.join(f'{m["type"]}@{m["start"]}' for m in inner)}"
                parts, hashed = [], 0
                for m in inner:
                    apart = m["start"] >= hashed
                    hashed = m["end"] if apart else hashed
                    parts.append({**m, "sha256": hashlib.sha256(b[m["start"] : m["end"]]).hexdigest() if apart else None})
                rows.append((k, n, len(s), hashlib.sha256(s).hexdigest(), zlib.crc32(s[-64:]), len(b), hashlib.sha256(b).hexdigest(), feature, corrected, parts))
            types = [batch.schema.field(key).type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), carved]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 10, types, strict=True)], names)

    return media.mapInArrow(run, f"{media.schema[key].simpleString().replace(':', ' ', 1)}, {DIGEST}")


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return digest(sniff(stored.withColumn("declared", F.lit("application/octet-stream")), "media", "declared"))


QUERIES = {"op7_media": op7_media}
ORACLES: dict[str, str] = {}
