"""Alignment of two tokenizers, best-fit packing and the divergence of sources, against plain Python."""

import bisect
import collections
import hashlib
import itertools
import random
import tracemalloc
import zlib
from unittest import mock

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from compare import connect, rows
from gridloom.llm import alignment, bestfit, divergence, pieces
from test_edges import SCHEMA, TEXTS, documents, empty, extra

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "  two  spaces   and\t tabs \n next\n\n last  ", " \n x", "\n", " ", "  ", "a▁b", "don't we'll I'VE x's 'tis", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<s> </s> <unk> <0x41>",
    "\x00 \x01 \x1c \x1f x\x1c y", "é é ﬁ 　  z  w \x85 q", "word,word. (word) [x]{y}~ `z` ßen über…", "\U0001f600\U0001f680 中文测试", "x" * 300 + " " + "y z" * 50,
]
ALL = [*TEXTS, *ODD]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA).repartition(3, "doc_id")


@pytest.mark.parametrize("plain", [True, False])
def test_byte_tokens_by_words_are_those_of_the_whole_text(plain):
    mine = pieces.ByteTokens(BYTE, plain)
    rng = random.Random(7)
    mixed = ["".join(rng.choice([" ", "  ", "\n", "\t", "a", "Bc", "é", ".", ",", "'s", "12", "中", " ", "\x1c"]) for _ in range(40)) for _ in range(400)]
    for t in [*filter(None, ALL), *mixed]:
        assert np.frombuffer(mine.encode(t), "<u4").tolist() == mine.tokenizer.encode(t, add_special_tokens=False).ids, t


def both_by_hand(texts):
    """Each text's (A tokens, B tokens) with ends, from the whole texts; None where one isn't given back."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel
    from tokenizers.pre_tokenizers import ByteLevel as Bytes

    a, b = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    letter = {}
    for c in map(chr, range(256)):
        for x, y in zip(Bytes(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0], c.encode(), strict=True):
            letter[x] = y
    out = []
    for t in texts:
        if not t:
            out.append(None)
            continue
        want = f" {t}".encode()
        of_a = a.encode(f" {t}", add_special_tokens=False).ids
        names = [a.id_to_token(i) for i in of_a]
        assert ByteLevel().decode(names).encode() == want
        of_b = b.encode(t)
        piece = [b.id_to_piece(i) for i in of_b]
        as_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(of_b, piece, strict=True)]
        if b"".join(as_bytes) != want:
            out.append(None)
            continue
        out.append(([*zip(of_a, np.cumsum([len(n) for n in names]).tolist(), strict=True)], [*zip(of_b, np.cumsum([len(x) for x in as_bytes]).tolist(), strict=True)]))
    return out


def aligned_by_hand(texts):
    found, count, done = both_by_hand(texts), collections.Counter(), []
    for x in found:
        if x is None:
            done.append(None)
            continue
        last = [{e: i for i, e in side} for side in x]
        common = sorted(last[0].keys() & last[1].keys())
        of = [[",".join(str(i) for i, _ in g) for _, g in itertools.groupby(side, key=lambda t: bisect.bisect_left(common, t[1]))] for side in x]  # noqa: B023
        links = [(last[0][e], last[1][e]) for e in common]
        count.update(links)
        done.append((len(x[0]), len(x[1]), ";".join(map("|".join, zip(*of, strict=True))), links))
    most = collections.Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if x is None else (x[0], x[1], len(x[3]), len(x[3]), sum(count[p] == most[p[1]] for p in x[3]), sum(count[p] for p in x[3]), hashlib.sha256(x[2].encode()).hexdigest()) for x in done]


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment(spark):
    texts = [t if t is None or len(t) < 20_000 else t[:9000] for t in ALL] + [TEXTS[5], TEXTS[5]]
    want = aligned_by_hand(texts)
    got = {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in alignment.align(extra(docs_of(spark, texts)), BYTE, PIECE).collect()}
    assert got == dict(enumerate(want)) and sum(w[0] > 0 for w in want) > 25
    assert alignment.align(empty(spark), BYTE, PIECE).count() == 0
    assert alignment.align(spark.createDataFrame([(None, "a text", None, None, None)], SCHEMA), BYTE, PIECE).first()["n_a"] == 2


def test_alignment_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    want = aligned_by_hand([r["text"] for r in docs])
    got = {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in alignment.op11_alignment(spark, data).collect()}
    assert got == {r["doc_id"]: w for r, w in zip(docs, want, strict=True)}


def test_runs_are_all_common_ends():
    rng = random.Random(3)
    for n in (1, 2, 5, 40, 300):
        for share in (0.05, 0.5, 0.95):
            ends = [sorted({n, *(e for e in range(1, n) if rng.random() < share or e % 7 == 0)}) for _ in range(2)]
            got = [(i + k, j + k) for i, j, m in alignment.runs(*ends) for k in range(m)]
            assert [ends[0][i] for i, _ in got] == sorted(set(ends[0]) & set(ends[1])) == [ends[1][j] for _, j in got]


def test_pairs_that_can_be_linked_are_bounded():
    of = [x.token_bytes() for x in (pieces.ByteTokens(BYTE, True), alignment.PieceIds(PIECE))]
    b = collections.Counter(of[1])
    longer = sum(b[x[k:]] for x in of[0] for k in range(len(x)))
    a = set(of[0])
    shorter = sum(x[k:] in a for x in of[1] for k in range(1, len(x)))
    assert longer + shorter < 1_000_000


def pieces_by_hand(texts, capacity=2048):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE)
    for k, x in enumerate(texts):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
        for i in range(len(edges) - 1):
            yield k, i, edges[i], edges[i + 1] - edges[i], zlib.crc32(ids[edges[i] : edges[i + 1]].tobytes())


def check_sequences(got, capacity=2048):
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_best_fit(spark):
    got = bestfit.best_fit(extra(documents(spark)), BYTE).collect()
    want = collections.Counter((k, *rest) for k, *rest in pieces_by_hand(TEXTS))
    for r in pieces_by_hand([TEXTS[5], TEXTS[12]]):
        want[((5, 12)[r[0]], *r[1:])] += 2 - r[0]
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    total = sum(r["length"] for r in got)
    assert check_sequences(got) == -(-total // 2048)
    assert bestfit.best_fit(empty(spark), BYTE).count() == 0
    nulls = bestfit.best_fit(spark.createDataFrame([(None, None, None, None, None)] * 3000, SCHEMA), BYTE).collect()
    assert check_sequences(nulls) == 2 and all(r["length"] == 1 for r in nulls)


def test_best_fit_query_and_its_sequences_whatever_the_partitions(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    keys = [*texts]
    want = {(keys[k], i, *rest) for k, i, *rest in pieces_by_hand([*texts.values()])}
    got = bestfit.op12_best_fit(spark, data).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    n = check_sequences(got)
    assert n <= 1 + 1.01 * sum(r["length"] for r in got) / 2048
    assert check_sequences(bestfit.best_fit(docs.repartition(61), BYTE).collect()) == n


def test_fullest_combination_is_that_of_all():
    rng = random.Random(5)
    for _ in range(200):
        left = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(1, 60)
        sums = {0}
        for n, c in left.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        out = bestfit.fullest(left, room)
        assert sum(n * m for n, m in out.items()) == max(s for s in sums if s <= room) and all(m <= left[n] for n, m in out.items())


def test_combinations_take_all_and_are_few():
    rng = random.Random(9)
    counts = {n: rng.randint(1, 10**9) for n in rng.sample(range(1, 2049), 700)}
    found = bestfit.combinations(counts, 2048)
    used = collections.Counter()
    for times, of in found:
        assert sum(n * m for n, m in of.items()) <= 2048
        for n, m in of.items():
            used[n] += times * m
    assert used == counts and len(found) <= sum(2048 // n + 1 for n in counts)
    assert sum(t for t, _ in found) <= 1.02 * sum(n * c for n, c in counts.items()) / 2048


def test_divergence_edges(spark, tmp_path):
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("X", "y", "é中", "")]
    rng = random.Random(1)
    made = []
    for i in range(900):
        text = " ".join(rng.choice(words[: 10 + i % 20]) + rng.choice(["", ".", "1", "\n", "…"]) for _ in range(rng.randint(0, 12)))
        made.append((i, text, rng.choice(["en", "en", "de", None, ""]), rng.choice(["s", "s", "s", "t", "ü", None])))
    made += [(None, None, "xx", "s"), (None, "a b", "xx", None), (1, "", "yy", "only"), *made[:40]]
    df = spark.createDataFrame([(*r, 1) for r in made], SCHEMA).repartition(5)
    for some, name in ((df, "all"), (df.limit(0), "none")):
        some.write.parquet(f"{tmp_path}/{name}")
        con = connect("/nowhere")
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
        got = divergence.audit(extra(spark.read.parquet(f"{tmp_path}/{name}"))).toPandas()
        want = con.sql(divergence.SQL).df()
        assert rows(got) == rows(want) and (len(got) > 50) == (name == "all")


def test_divergence_of_a_long_text(spark):
    text = " ".join(f"w{i % 50}x" for i in range(900_000))  # more than one step
    got = divergence._count(iter([spark.createDataFrame([(text, "en", "s")], "text string, lang string, source string").toArrow().to_batches()[0]]))
    counts = {r["term"]: (r["n"], r["docs"]) for b in got for r in b.to_pylist()}
    assert counts == {None: (0, 0), "w": (900_000, 1), "x": (900_000, 1)}


def test_new_words_are_tokenized_in_one_text():
    """As each alone: with words that end in white space, marks, other scripts and texts that a model doesn't give back."""
    first, second = alignment.pair_of(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    words = ["quokka", "zebra,", "don't", "naïve", "日本語", "x\ny", "tail\n", "", " lead", "a" * 70, "ﬁne", "　wide", "<|endoftext|>", "</s>", "1234567", "🙂ok", *(f"w{k}ord" for k in range(40))]
    for kept in (first, second):
        kept.clear()
        calls, joined = [], kept.ids.joined
        kept.ids.joined = lambda w, f=joined, c=calls: c.append(len(w)) or f(w)
        try:
            kept.tokens(words)
            learnt = dict(kept)
            assert max(calls) >= 40 and len(learnt) == len(words) - 1  # the long one isn't remembered
        finally:
            kept.ids.joined = joined
        kept.clear()
        assert learnt == {w: kept[w] for w in words if len(w) <= 64}
        kept.clear()


@pytest.mark.parametrize("plain", [True, False])
def test_byte_texts_are_those_of_whole_texts(plain, monkeypatch):
    """Whatever the steps, with words forgotten and texts that are cut elsewhere, and where tokens don't give the text back."""
    rng = random.Random(11)
    mixed = ["".join(rng.choice([" ", "a", "Bc ", "é", ".", ",", "'s", "12", "中 ", "\n", "\u2003", "\x1c", "\xa0"]) for _ in range(40)) for _ in range(300)]
    texts = [None, "", *ALL, None, *mixed, "x ", "x\n", *mixed[:50]]
    tokenizer = pieces.ByteTokens(BYTE, plain).tokenizer
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for slice_, joined, step, many in ((1 << 24, 1 << 16, 1 << 16, 1 << 20), (500, 60, 7, 40)):
        for name, value in (("SLICE", slice_), ("JOINED", joined), ("STEP", step), ("MANY_WORDS", many)):
            monkeypatch.setattr(pieces, name, value)
        mine = pieces.ByteTexts(BYTE, plain)
        for kind in (pa.string(), pa.large_string()):
            assert [np.frombuffer(b, "<u4").tolist() for b in mine.encode(pa.array(["before", *texts], kind)[1:])] == want
        assert many > 40 or len(mine.known) < 200
        mine = pieces.ByteTexts(BYTE, plain)
        mine.bytes[1::2] = 0
        assert [np.frombuffer(b, "<u4").tolist() for b in mine.encode(pa.array(texts))] == want
    assert [*mine.encode(pa.array([], pa.string()))] == [] and [*mine.encode(pa.array([None], pa.string()))] == [b""]


def test_words_of_best_fit_are_tokenized_once_and_in_joined_texts(monkeypatch):
    words = [f"{a}{b}{mark}" for a in "abcdefghij" for b in ("one", "two", "three\nFour", "ü") for mark in ("", ".", ",")]
    rng = random.Random(2)
    texts = [" ".join(["Head", *rng.sample(words, 60)]) for _ in range(50)]
    pieces.byte_texts.cache_clear()
    mine = pieces.byte_texts(BYTE)
    whole, joined, learnt = mine.tokens.whole, mine.joined, []
    alone: list[str] = []
    monkeypatch.setattr(mine.tokens, "whole", lambda t: alone.append(t) or whole(t))
    monkeypatch.setattr(mine, "joined", lambda w, n: learnt.append(w) or joined(w, n))
    for _ in range(2):
        assert [len(b) // 4 for b in mine.encode(pa.array(texts))] == [len(mine.tokens.tokenizer.encode(t).ids) for t in texts]
    assert len(learnt) == 1 and sorted(learnt[0]) == sorted(words) and set(alone) == {"Head"}
    pieces.byte_texts.cache_clear()


def test_words_of_alignment_are_tokenized_once_in_joined_texts(monkeypatch):
    """Over all documents of a slice, also those with spaces behind white space; once more only where they were forgotten."""
    words = [f"{a}{b}{mark}" for a in "abcdefghij" for b in ("one", "two", "three\nFour", "ü") for mark in ("", ".", ",")]
    rng = random.Random(2)
    texts = [("" if k % 2 else "Head\n  of all ") + " ".join(rng.sample(words, 60)) for k in range(50)]
    batch = pa.record_batch([pa.array(range(50)), pa.array(texts)], ["doc_id", "text"])
    for cached in (alignment.pair_of, alignment.words_of):
        cached.cache_clear()
    calls = []
    for side in alignment.words_of(BYTE, PIECE):
        monkeypatch.setattr(side.tokens.ids, "joined", lambda w, f=side.tokens.ids.joined: calls.append(sorted(w)) or f(w))
    got = [alignment._slice(batch, *alignment.words_of(BYTE, PIECE)) for _ in range(2)]
    first, again = ([r for b in x for r in b.to_pylist()] for x in got)
    assert first == again and [(r["n_a"], r["n_b"]) for r in first] == [(len(a), len(b)) for a, b in both_by_hand(texts)]
    assert len(calls) == 2 and calls[0] == calls[1] == sorted({*words, "Head\n  of", "all"})
    for cached in (alignment.pair_of, alignment.words_of):
        cached.cache_clear()


def test_alignment_whatever_the_steps(spark, monkeypatch):
    """Slices, blocks, joined texts and remembered words of few; mixed white space, and words that aren't given back among others."""
    rng = random.Random(13)
    parts = [" ", "  ", "a", "Bc ", "é", ".", ",", "'s", "12 ", "中 ", "\n", " ", "　 ", "\x1c", "\x85", "\xa0 ", "ﬁ", "word ", *["x "] * 30, "▁"]
    texts = [*ALL[:8], None, "", *ODD, *("".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(300)), " ".join(f"w{k}" for k in range(300)) + " a▁"]
    texts = [t if t is None or len(t) < 20_000 else t[:9000] for t in texts]
    want = aligned_by_hand(texts)
    assert 20 < sum(w[0] == 0 for w in want) < 300
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").toArrow().combine_chunks().to_batches()[0]
    digests = {}
    for slice_, joined, step, many, tokens in ((1 << 24, 1 << 16, 1 << 16, 1 << 20, 1 << 19), (500, 60, 7, 40, 50)):
        for name, value in (("SLICE", slice_), ("JOINED", joined), ("STEP", step), ("MANY_WORDS", many)):
            monkeypatch.setattr(pieces, name, value)
        monkeypatch.setattr(alignment, "TOKENS", tokens)
        pair = [alignment.SizedWords(x) for x in alignment.pair_of(BYTE, PIECE)]
        sizes = np.cumsum([0, *(len((t or "").encode()) for t in texts)])
        got = [r for x, y in alignment.ranges(sizes, slice_) for b in alignment._slice(docs.slice(x, y - x), *pair) for r in b.to_pylist()]
        assert {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], len(r["a"]) // 2, len(r["b"]) // 2, r["groups_sha256"]) for r in got} == {k: (w[0], w[1], w[2], w[2], w[2], w[6]) for k, w in enumerate(want)}
        digests[many] = sorted((r["doc_id"], r["a"], r["b"]) for r in got)
    assert digests[40] == digests[1 << 20]


def test_words_are_remembered_within_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_BYTES", 20_000)
    mine = pieces.ByteTexts(BYTE)
    for k in range(20):
        text = f"a b{k} " + f"{k}x" * 2000
        assert [len(b) // 4 for b in mine.encode(pa.array([text]))] == [len(mine.tokens.tokenizer.encode(text).ids)]
        assert mine.known.nbytes + mine.ids.nbytes <= 20_000
    assert 0 < len(mine.known) < 40


def linked(a, b, sizes):
    """A batch of documents with so many of these links each, as it comes from aligned, and one row that isn't of it."""
    edges = pa.py_buffer(np.cumsum([0, 1, *sizes]).astype(np.int32) * 2)
    ids = [pa.Array.from_buffers(pa.binary(), len(sizes) + 1, [None, edges, pa.py_buffer(np.append([1], x).astype("<u2"))]) for x in (a, b)]
    rows = pa.array(range(len(sizes) + 1))
    return pa.RecordBatch.from_arrays([*[rows] * 4, rows.cast(pa.string()), *ids], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "a", "b"])[1:]


def peak_mb(f):
    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_links_are_counted_and_looked_up_a_few_at_a_time(monkeypatch):
    """Whatever the steps: documents over several of them, on their edges, and without links; memory doesn't grow with a batch."""
    rng = np.random.default_rng(5)
    for sizes, steps in (([0, 3, 0, 25, 7, 7, 1, 0], (1, 7, 1 << 20)), ([0, 0], (7,)), ([], (7,)), ([5_000_000, 0, 3_000_000], (None,))):
        a, b = rng.integers(0, 200, sum(sizes)), rng.integers(0, 150, sum(sizes))
        batch = linked(a, b, sizes)
        want, count = np.unique(a | b << 16, return_counts=True)
        most = np.array([count[want >> 16 == j].max(initial=0) for j in range(150)])
        best = count == most[want >> 16]
        of = np.searchsorted(want, a | b << 16)
        at = np.cumsum([0, *sizes])
        sums = [[int(best[of[x:y]].sum()), int(count[of[x:y]].sum())] for x, y in itertools.pairwise(at)]
        for step in steps:
            if step:
                monkeypatch.setattr(alignment, "LINKS", step)
            else:
                monkeypatch.undo()
            (got,), counting = peak_mb(lambda: [*alignment._counted(iter([batch]))])  # noqa: B023
            assert (got["pair"].to_pylist(), got["n"].to_pylist()) == (want.tolist(), count.tolist())
            got, looking = peak_mb(lambda: alignment._looked_up(batch, want.astype(np.uint32), count, best))  # noqa: B023
            assert [[r["n_links"], r["n_best"], r["count_sum"]] for r in got.to_pylist()] == [[n, *s] for n, s in zip(sizes, sums, strict=True)]
            assert max(counting, looking) < 60


def test_texts_are_aligned_in_small_slices(monkeypatch):
    """Of a batch with much text, little is held as words and tokens at once."""
    docs, found = mock.MagicMock(), []
    docs.select.return_value.mapInArrow = lambda f, _: f
    monkeypatch.setattr(alignment, "_slice", lambda batch, *_: [found.append(batch)])
    batch = pa.record_batch([pa.array(range(90)), pa.array(["many words " * 20_000] * 80 + [None, "", "x" * 9_000_000, *["few"] * 7])], ["doc_id", "text"])
    assert len([*alignment.aligned(docs, BYTE, PIECE)(iter([batch, batch[:0]]))]) == len(found)
    assert [r for x in found for r in x["doc_id"].to_pylist()] == [*range(90)]
    assert all(pa.compute.sum(pa.compute.binary_length(x["text"])).as_py() <= 5_000_000 or x.num_rows == 1 for x in found)


def test_words_without_a_text_of_their_own_are_held_once():
    """Words that are looked up alone stand in the arrays, not in a dictionary too."""
    first, second = (alignment.SizedWords(x) for x in alignment.pair_of(BYTE, PIECE))
    words = pa.array([f"w{k}\n" for k in range(500)])
    for side in (first, second):
        at = side.learn(words)
        assert side.learn(words).tolist() == at.tolist() and len(side.known) == 500 and len(side.tokens) == 0
