"""Byte-level BPE encoding and decoding on numpy matrices.

Distinct pretokens are dealt into buckets by length and laid out as the rows of a padded matrix of
byte tokens. In each round every unfinished row merges its leftmost pair of minimum rank: ranks of
neighbouring pairs come from a hash table of (left, right) pairs, the merged column is squeezed out,
and rows without a mergeable pair leave the matrix. Token ids travel as little-endian unsigned
32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_or_empty

NONE = np.iinfo(np.int32).max
#: Widest matrix row; longer pretokens merge one by one on a heap, with the same result.
WIDEST = 256
_CELLS = 1 << 20
_CHUNK_WORDS = 100_000
_KNOWN_WORDS = 200_000


class Vocabulary:
    """Ranks of byte strings, and the hash table of the pairs that merge into one of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, merged = np.array(pairs or [(0, 0, 0)], np.int64).T
        bits = max(4, (2 * len(left)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, np.int64)
        self._values = np.full(1 << bits, NONE, np.int32)
        todo = np.arange(len(pairs))
        keys = (left << 32) | right
        slots, self._probes = self._slot(keys), 0
        while len(todo):  # every key takes the first free slot after its own, one key a slot
            self._probes += 1
            at = slots[todo]
            free = self._keys[at] == -1
            chosen = todo[free][np.unique(at[free], return_index=True)[1]]
            self._keys[slots[chosen]], self._values[slots[chosen]] = keys[chosen], merged[chosen]
            todo = todo[~np.isin(todo, chosen)]
            slots[todo] = (slots[todo] + 1) & self._mask

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair merges into; NONE where it has none or a side is padding (-1)."""
        out = np.full(left.shape, NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        keys = (left.ravel()[todo].astype(np.int64) << 32) | right.ravel()[todo]
        slots, flat = self._slot(keys), out.reshape(-1)
        for _ in range(self._probes):
            held = self._keys[slots]
            hit = held == keys
            flat[todo[hit]] = self._values[slots[hit]]
            on = ~hit & (held != -1)
            if not on.any():
                break
            todo, keys, slots = todo[on], keys[on], (slots[on] + 1) & self._mask
        return out


def _merge_matrix(vocabulary: Vocabulary, words: list[bytes], width: int) -> list[np.ndarray]:
    """Token ids of ``words``, none longer than ``width`` bytes."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    grid = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    ids = np.where(np.arange(width) < lengths[:, None], vocabulary.byte_ids[grid], np.int32(-1))
    out: list[np.ndarray] = [None] * len(words)
    rows = np.arange(len(words))
    ranks = vocabulary.lookup(ids[:, :-1], ids[:, 1:])
    while len(rows):
        best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
        low = np.take_along_axis(ranks, best[:, None], 1)[:, 0] if ranks.shape[1] else np.full(len(rows), NONE)
        done = low == NONE
        if done.any():
            for i, row, n in zip(rows[done].tolist(), ids[done], (ids[done] >= 0).sum(axis=1).tolist(), strict=True):
                out[i] = row[:n]
            on = ~done
            rows, ids, ranks, best, low = rows[on], ids[on], ranks[on], best[on], low[on]
            if not len(rows):
                break
        at = np.arange(len(rows))
        ids[at, best] = low
        ids = np.where(np.arange(ids.shape[1] - 1) <= best[:, None], ids[:, :-1], ids[:, 1:])
        ranks = np.where(np.arange(ranks.shape[1] - 1) < best[:, None], ranks[:, :-1], ranks[:, 1:])
        if ranks.shape[1]:
            before = np.flatnonzero(best > 0)
            ranks[before, best[before] - 1] = vocabulary.lookup(ids[before, best[before] - 1], ids[before, best[before]])
            after = np.flatnonzero(best < ranks.shape[1])
            ranks[after, best[after]] = vocabulary.lookup(ids[after, best[after]], ids[after, best[after] + 1])
    return out


def _merge_long(vocabulary: Vocabulary, word: bytes) -> np.ndarray:
    """The same merges on a linked list and a heap, for a pretoken of any length."""
    tokens, ranks = vocabulary.tokens, vocabulary.ranks
    ids = vocabulary.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))

    def pair(i: int) -> int | None:
        return ranks.get(tokens[ids[i]] + tokens[ids[after[i]]]) if after[i] < len(ids) else None

    heap = [(rank, i) for i in range(len(ids)) if (rank := pair(i)) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        if ids[i] < 0 or pair(i) != rank:
            continue
        gone = after[i]
        ids[i], ids[gone], after[i] = rank, -1, after[gone]
        if after[i] < len(ids):
            before[after[i]] = i
        for j in (before[i], i):
            if j >= 0 and (rank := pair(j)) is not None:
                heapq.heappush(heap, (rank, j))
    return np.array([i for i in ids if i >= 0], np.int32)


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> list[np.ndarray]:
    """Token ids of each pretoken."""
    out: list[np.ndarray] = [None] * len(words)
    buckets: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        buckets.setdefault(max(2, 1 << (len(word) - 1).bit_length()) if word else 2, []).append(i)
    for width, members in buckets.items():
        if width > WIDEST:
            for i in members:
                out[i] = _merge_long(vocabulary, words[i])
            continue
        rows = max(1, _CELLS // width)
        for k in range(0, len(members), rows):
            some = members[k:k + rows]
            for i, ids in zip(some, _merge_matrix(vocabulary, [words[i] for i in some], width), strict=True):
                out[i] = ids
    return out


class Encoder:
    """Encodes texts; pretokens seen lately are kept, at most _KNOWN_WORDS and one chunk of them."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self._codes: dict[str, int] = {}
        self._ids, self._lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All token ids in order, and how many each word has."""
        if len(self._codes) > _KNOWN_WORDS:
            self._forget()
        found = list(map(self._codes.get, words))
        unknown = list(dict.fromkeys(w for w, code in zip(words, found, strict=True) if code is None))
        if unknown:
            self._codes.update(zip(unknown, range(len(self._codes), len(self._codes) + len(unknown)), strict=True))
            new = merge_words(self.vocabulary, [w.encode() for w in unknown])
            self._ids = np.concatenate([self._ids, *new])
            self._lengths = np.concatenate([self._lengths, np.fromiter(map(len, new), np.int64, len(new))])
            found = list(map(self._codes.get, words))
        codes = np.array(found, np.int64)
        lengths, starts = self._lengths[codes], (np.cumsum(self._lengths) - self._lengths)[codes]
        shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        return self._ids[shift + np.arange(len(shift))], lengths

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        words: list[str] = []
        ends: list[int] = []

        def flush() -> Iterator[bytes]:
            ids, lengths = self._encode_words(words)
            cut = np.concatenate([[0], np.cumsum(lengths)])
            for a, b in zip([0, *ends], ends, strict=False):
                yield ids[cut[a]:cut[b]].astype("<u4").tobytes()
            words.clear()
            ends.clear()

        for text in texts:
            matches = (m.group() for m in self.pattern.finditer(text)) if len(text) > _CHUNK_WORDS else \
                iter(self.pattern.findall(text))
            head = list(islice(matches, _CHUNK_WORDS))
            if ends and (len(head) == _CHUNK_WORDS or len(words) + len(head) > _CHUNK_WORDS):
                yield from flush()
            if len(head) == _CHUNK_WORDS:  # a very long text: chunk by chunk
                parts = []
                while head:
                    words.extend(head)
                    ends.append(len(words))
                    parts.extend(flush())
                    head = list(islice(matches, _CHUNK_WORDS))
                yield b"".join(parts)
                continue
            words.extend(head)
            ends.append(len(words))
        if ends:
            yield from flush()


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(_vocabulary(path), pattern)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Binary column of the ids of ``text`` under the rank file ``path``; null counts as empty."""
    @F.pandas_udf(T.BinaryType())
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(_encoder(path, pattern).encode(texts.fillna(""))), dtype=object)

    return ids(text)


def _decoded(packed: bytes, token) -> bytes:
    size, step = len(packed) // 4, _CHUNK_WORDS
    return b"".join(b"".join(map(token, np.frombuffer(packed, "<u4", min(step, size - i), 4 * i).tolist()))
                    for i in range(0, size, step))


def decode(ids: Column, path: str) -> Column:
    """Binary column of the bytes that ``ids``, as ``encode`` gives them, stand for; null gives null."""
    @F.pandas_udf(T.BinaryType())
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        token = _vocabulary(path).tokens.__getitem__
        for rows in batches:
            yield rows.map(lambda x: None if x is None else _decoded(x, token))

    return decoded(ids)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Struct ``row`` (all columns of ``docs``), token_ids and decoded, binary, of every whole ``text``.

    Null and empty texts give no ids and no bytes; repeated rows and ties are rows like others; the
    columns of ``docs`` may have any names.
    """
    @F.pandas_udf("token_ids binary, decoded binary")
    def there_and_back(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:  # one worker for both ways
        token = _vocabulary(path).tokens.__getitem__
        for texts in batches:
            ids = list(_encoder(path, pattern).encode(texts))
            yield pd.DataFrame({"token_ids": ids, "decoded": [_decoded(x, token) for x in ids]})

    done = docs.select(F.struct("*").alias("row"), there_and_back(text_or_empty()).alias("done"))
    return done.select("row", "done.token_ids", "done.decoded")
