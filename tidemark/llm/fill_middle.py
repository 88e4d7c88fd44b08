"""Fill-in-the-middle transformation.

A text is cut into prefix, middle and suffix at two unit boundaries and written in another order, with a
sentinel before each part. Units are runs of ASCII letters and single other code points. The UTF-8 bytes of a
text are divided into fixed blocks; two Fenwick trees over the blocks hold how many units and how many code
points begin in each. Binary-lifting descent finds the block in which the unit at a cut begins, and only
that block is searched for the boundary; the code points before it come from the other tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_or_empty

# The sentinels.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Production parameters: seed; percent of texts left plain; percent of the others with the suffix first;
#: bytes of a block.
SEED = 1
PLAIN_PERCENT = 10
SUFFIX_FIRST_PERCENT = 20
BLOCK_BYTES = 4096

_STRIDE_BLOCKS = 256  # blocks whose flags are held at a time
_BATCH_BYTES = 8 << 20  # text that one output batch may hold, but for a single longer text


def _starts(data: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of data[begin:end]: does a code point begin there, and does a unit?"""
    piece = data[begin:end]
    point = (piece & 0xC0) != 0x80
    letter = ((piece | 0x20) - np.uint8(97)) < 26  # wraps below the letters
    after_letter = np.empty(len(piece), bool)
    after_letter[1:] = letter[:-1]
    if len(piece):
        after_letter[0] = begin > 0 and 97 <= (int(data[begin - 1]) | 0x20) <= 122
    return point, point & ~(letter & after_letter)


class Fenwick:
    """Prefix sums of non-negative counts under point updates."""

    def __init__(self, counts: np.ndarray):
        at = np.arange(1, len(counts) + 1)
        sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.tree = np.concatenate([[0], sums[at] - sums[at - (at & -at)]]).tolist()
        self.top = 1 << (len(counts).bit_length() - 1) if len(counts) else 0

    def add(self, block: int, change: int) -> None:
        i = block + 1
        while i < len(self.tree):
            self.tree[i] += change
            i += i & -i

    def before(self, block: int) -> int:
        """The sum of the counts of the blocks before ``block``."""
        total, i = 0, block
        while i:
            total += self.tree[i]
            i &= i - 1
        return total

    def descend(self, k: int) -> tuple[int, int]:
        """The block that holds item ``k`` (from 0), and how many items lie before that block; for ``k`` at the
        total or above, the number of blocks and the total."""
        block, before, step = 0, 0, self.top
        while step:
            at = block + step
            if at < len(self.tree) and before + self.tree[at] <= k:
                block, before = at, before + self.tree[at]
            step >>= 1
        return block, before


class TextIndex:
    """Unit boundaries of a UTF-8 text through trees over its blocks."""

    def __init__(self, data: bytes, block: int = BLOCK_BYTES):
        self.data, self.block = np.frombuffer(data, np.uint8), block
        units, points = [], []
        stride = block * _STRIDE_BLOCKS
        for begin in range(0, len(data), stride):
            end = min(begin + stride, len(data))
            point, unit = _starts(self.data, begin, end)
            firsts = np.arange(0, end - begin, block)
            units.append(np.add.reduceat(unit, firsts, dtype=np.int64))
            points.append(np.add.reduceat(point, firsts, dtype=np.int64))
        none = np.zeros(0, np.int64)
        self.units, self.points = (Fenwick(np.concatenate(c or [none])) for c in (units, points))
        self.n_units = sum(int(c.sum()) for c in units)
        self.n_points = sum(int(c.sum()) for c in points)

    def boundary(self, k: int) -> tuple[int, int]:
        """(bytes, code points) before unit ``k``; of the whole text where ``k`` is the number of units."""
        if k >= self.n_units:
            return len(self.data), self.n_points
        block, before = self.units.descend(k)
        begin = block * self.block
        point, unit = _starts(self.data, begin, min(begin + self.block, len(self.data)))
        at = int(np.flatnonzero(unit)[k - before])
        return begin + at, self.points.before(block) + int(point[:at].sum())


@dataclass(frozen=True)
class Middle:
    """A transformed text; ``prefix_chars`` and ``middle_chars`` are None where it is plain."""
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers below 2**32: the first digits of the hash of ``seed:doc_id`` (a null id is no digits)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, h: list[int], plain_percent: int = PLAIN_PERCENT,
              suffix_first_percent: int = SUFFIX_FIRST_PERCENT, block: int = BLOCK_BYTES) -> Middle:
    """``text`` cut and rearranged as the four draws ``h`` say."""
    data = text.encode("utf-8", "surrogatepass")
    index = TextIndex(data, block)
    n = index.n_units
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= 100 - plain_percent:
        return Middle(n, "plain", None, None, text)
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (_, a), (_, b) = index.boundary(first), index.boundary(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < suffix_first_percent:
        return Middle(n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
    return Middle(n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")


def restore(output: str, form: str) -> str:
    """The text that ``transform`` gave ``output`` and ``form`` for: no part holds a sentinel, so each is found."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    at, last = output.index(second, len(first)), output.rindex(MIDDLE)
    one, two, middle = output[len(first):at], output[at + len(second):last], output[last + len(MIDDLE):]
    return one + middle + two if form == "psm" else two + middle + one


def _in_pieces(texts: pd.Series) -> Iterator[slice]:
    """Slices of the batch that hold _BATCH_BYTES of text, or a single longer one."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held > _BATCH_BYTES and i > first:
            yield slice(first, i)
            first, held = i, len(text)
    if len(texts):
        yield slice(first, len(texts))


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT,
                   suffix_first_percent: int = SUFFIX_FIRST_PERCENT, block: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_units, form, prefix_chars, middle_chars, output and restored, one row per row of ``docs`` (doc_id, text).

    Whole texts are cut. A null text counts as empty; empty texts, and texts that hold a sentinel, are plain
    whatever the draw, and then prefix_chars and middle_chars are null. ``restored`` is the text rebuilt
    from output and form alone. Rows that share a doc_id get the same draws, a null doc_id those of an empty
    id; repeated rows each get a row; an empty table gives none; other columns are not read.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _in_pieces(batch["text"]):
                ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"][part]]
                done = [transform(t, draws(i, seed), plain_percent, suffix_first_percent, block)
                        for i, t in zip(ids, batch["text"][part], strict=True)]
                yield pd.DataFrame({
                    "doc_id": pd.array(ids, "Int64"), "n_units": [m.n for m in done], "form": [m.form for m in done],
                    "prefix_chars": pd.array([m.prefix_chars for m in done], "Int64"),
                    "middle_chars": pd.array([m.middle_chars for m in done], "Int64"),
                    "output": [m.output for m in done], "restored": [restore(m.output, m.form) for m in done]})

    named = docs.select(F.col("doc_id").cast(T.LongType()).alias("doc_id"), text_or_empty().alias("text"))
    # Ids travel as text: a batch with a null id would else hold them as floats.
    return (named.withColumn("doc_id", F.col("doc_id").cast("string"))
            .mapInPandas(cut, "doc_id long, n_units long, form string, prefix_chars long, middle_chars long, "
                              "output string, restored string"))
