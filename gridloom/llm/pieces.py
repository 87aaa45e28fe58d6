"""Token ids of texts by words: tokens never reach over a space behind a character that is no white space.

So a text is cut before such spaces, and the ids of a space and what follows it are remembered, within bounds.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a Python worker remembers, and the most characters of one.
CACHE_WORDS, CACHE_CHARS = 500_000, 64
_MORE_SPACES = re.compile(r"\s ").search
_CUT = re.compile(r"(?<=\S)(?= )").split
#: White space in Arrow's regular expressions, all that Python's and the tokenizers' \s has.
_WHITE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Words that are remembered where they stand in one array, and the most bytes of these and their tokens.
MANY_WORDS, KNOWN_BYTES = 500_000, 1 << 25
#: Bytes of texts whose words are told apart at once, of new words that are tokenized in one text; words whose ids are copied at once.
SLICE, JOINED, STEP = 1 << 22, 1 << 16, 1 << 16


def spaced(text: str) -> tuple[str, list[str]]:
    """What stands before the first cut, and what follows each cut's space."""
    if _MORE_SPACES(text) is None:
        head, *rest = text.split(" ")
        return head, rest
    head, *rest = _CUT(text)
    return head, [x[1:] for x in rest]


class ByteTokens(dict):
    """Ids of a byte-level BPE as little-endian 32-bit integers, by what follows a space.

    Letters with a space before them, and marks (no apostrophe) behind letters, are tokenized apart, so these go straight to
    the tokenizer's model in its byte alphabet. All else goes through the whole tokenizer. plain: the strings of special
    tokens are text like any other.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        alphabet = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))]
        self.map = {ord(c): alphabet.pre_tokenize_str(c)[0][0] for c in (" ", *letters)}
        self.space = self.map[32]
        self.simple = re.compile(f"([{''.join(letters)}]+)([!-&(-/:;=?@\\[-`{{}}~]*)").fullmatch
        self.model = self.tokenizer.model.tokenize
        self.marks: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def joined(self, words: list[str]) -> list[int]:
        """Ids of the words, each with a space before it."""
        return self.tokenizer.encode_batch_fast([f" {' '.join(words)}"], add_special_tokens=False)[0].ids

    def of(self, word: str) -> bytes:
        """Ids of a space and the word, not remembered."""
        m = self.simple(word) if len(word) < 100 else None
        if m is None:
            return self.whole(f" {word}")
        ids = b"".join([x.id.to_bytes(4, "little") for x in self.model(self.space + m[1].translate(self.map))])
        if m[2]:
            if m[2] not in self.marks:
                self.marks[m[2]] = self.whole(m[2])
            ids += self.marks[m[2]]
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.of(word)
        if len(word) <= CACHE_CHARS:
            self[word] = ids
        return ids

    def bound(self) -> None:
        """Forget all words once there are many; to be called now and then."""
        if len(self) > CACHE_WORDS:
            self.clear()
            self.marks.clear()

    def encode(self, text: str) -> bytes:
        head, rest = spaced(text)
        return (self.whole(head) if head else b"") + b"".join(map(self.__getitem__, rest))

    def token_bytes(self) -> list[bytes]:
        """By id, the bytes that a token stands for."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes whose letter in the vocabulary is their own
        of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        return [bytes(map(of.__getitem__, t)) for t in map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))]


class KnownWords:
    """Tokens of words, remembered in arrays: the k-th of the known words has size[k] tokens, from start[k] on in ids.

    joined and apart, of subclasses, give the tokens of new words in turn, and how many each has: joined of many words in one
    text, each behind a space, where words end in no white space and have those lengths in bytes; apart of each alone.
    """

    joined: Callable[[list[str], np.ndarray], tuple[np.ndarray, np.ndarray]]
    apart: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]

    def __init__(self):
        self._keep(pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64))

    def learn(self, words: pa.Array) -> np.ndarray:
        """Where each of the distinct words is known, with the new ones behind the others."""
        at = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            odd = pc.match_substring_regex(words.take(new), f"(^|{_WHITE})\\z").to_numpy(zero_copy_only=False)
            new = np.concatenate([new[~odd], new[odd]])
            at[new] = len(self.known) + np.arange(len(new))
            more, alone = words.take(new), len(new) - int(odd.sum())
            lengths = pc.binary_length(more).to_numpy(zero_copy_only=False).astype(np.int64)
            edges = np.flatnonzero(np.diff(np.cumsum(lengths[:alone] + 1) // JOINED)) + 1
            found = [self.joined(more[a:z].to_pylist(), lengths[a:z]) for a, z in pairwise([0, *edges.tolist(), alone]) if a < z]
            found.append(self.apart(more[alone:].to_pylist()))
            ids, size = (np.concatenate(x) for x in zip((self.ids, self.size), *found, strict=True))
            self._keep(pa.concat_arrays([self.known, more]), ids, size)
        return at

    def _keep(self, known: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.known, self.ids, self.size, self.start = known, ids, size, np.cumsum(size) - size

    def copied(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words known at these places, in turn, and where those of each word begin and end."""
        edges = np.concatenate([[0], np.cumsum(self.size[at])])
        out = np.empty(edges[-1], "<u4")
        for k in range(0, len(at), STEP):
            some = at[k : k + STEP]
            low, high = edges[k], edges[k + len(some)]
            shift = self.start[some] - (edges[k : k + len(some)] - low)
            out[low:high] = self.ids[np.repeat(shift, self.size[some]) + np.arange(high - low)]
        return out, edges

    def bound(self, at: np.ndarray) -> None:
        """Once there are many words, or they take many bytes, forget all but those at these places, the last ones met, that aren't long."""
        if len(self.known) > MANY_WORDS or self.known.nbytes + self.ids.nbytes > KNOWN_BYTES:
            words = self.known.take(at)
            short = pc.binary_length(words).to_numpy(zero_copy_only=False) <= CACHE_CHARS
            self._keep(words.filter(short), self.copied(at[short])[0], self.size[at[short]])


class ByteTexts(KnownWords):
    """Ids of many texts at once, those of ByteTokens: equal words meet in Arrow, and only new ones are tokenized, in joined texts."""

    def __init__(self, path: str, plain: bool = False):
        super().__init__()
        self.tokens = ByteTokens(path, plain)
        tokenizer = self.tokens.tokenizer
        self.bytes = np.array([len(tokenizer.id_to_token(i) or "") for i in range(tokenizer.get_vocab_size())])

    def joined(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.tokens.joined(words), "<u4")
        ends, want = np.cumsum(self.bytes[ids]), np.cumsum(lengths + 1)
        at = np.searchsorted(ends, want)
        if len(ids) == 0 or ends[-1] != want[-1] or (ends[at] != want).any():  # tokens that don't give the text back
            return self.apart(words)
        return ids, np.diff(at, prepend=-1)

    def apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.tokens.whole(f" {w}") for w in words]
        return np.frombuffer(b"".join(found), "<u4"), np.array([len(b) // 4 for b in found], np.int64)

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Each text's ids, none for null; a slice of the texts at a time."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        edges = np.flatnonzero(np.diff(ends // SLICE)) + 1
        for a, z in pairwise([0, *edges.tolist(), len(texts)]):
            if a < z:
                yield from self._slice(pc.fill_null(texts[a:z].cast(pa.string()), ""))

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        spaces = pc.match_substring_regex(texts, f"{_WHITE} ")  # these are cut elsewhere
        lists = pc.split_pattern(pc.if_else(spaces, "", texts), " ")
        flat, first = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        follows = np.ones(len(flat), bool)
        follows[first[:-1]] = False
        heads, found = flat.take(first[:-1]).to_pylist(), flat.filter(follows).dictionary_encode()
        at = self.learn(found.dictionary)
        ids, edges = self.copied(at[found.indices.to_numpy()])
        self.bound(at)
        of = edges[first - np.arange(len(first))].tolist()
        for k, (head, odd) in enumerate(zip(heads, spaces.to_pylist(), strict=True)):
            if odd:
                yield self.tokens.encode(texts[k].as_py())
                self.tokens.bound()
            else:
                yield (self.tokens.whole(head) if head else b"") + ids[of[k] : of[k + 1]].tobytes()


@lru_cache(2)
def byte_texts(path: str, plain: bool = False) -> ByteTexts:
    """One for each worker."""
    return ByteTexts(path, plain)
