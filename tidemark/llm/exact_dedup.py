"""Exact dedup through counting quotient filters.

Every input partition inserts the 64-bit fingerprints of its normalised texts into a counting
quotient filter: the high bits (quotient) choose a slot run, the low bits (remainder) are kept in
it sorted, each with its count. Runs are shipped in blocks of neighbouring quotients; filters of all
partitions merge block by block by merging sorted remainders and adding counts, which loses nothing
because remainder and quotient together are the whole fingerprint. A fingerprint with a count above
one may still be a hash collision, so its rows, and only they, go to a comparison of the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import collapse_spaces, left_join_hot, store, text_or_empty

#: Fingerprints that a merged block is planned to hold.
BLOCK_ROWS = 50_000

_RUNS = "block long, quotients binary, remainders binary, counts binary"


class QuotientFilter:
    """Sorted (quotient, remainder) slots with counts; ``bits`` of the fingerprint are the quotient."""

    def __init__(self, bits: int, slots: np.ndarray, counts: np.ndarray):
        self.bits, self.slots, self.counts = bits, slots, counts

    @classmethod
    def of(cls, bits: int, fingerprints: np.ndarray) -> QuotientFilter:
        slots, counts = np.unique(fingerprints.astype(np.uint64), return_counts=True)
        return cls(bits, slots, counts.astype(np.int64))

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        """Merge the sorted remainders of each quotient, adding the counts of equal ones."""
        slots = np.concatenate([self.slots, other.slots])
        order = np.argsort(slots, kind="stable")
        slots, counts = slots[order], np.concatenate([self.counts, other.counts])[order]
        first = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]]) if len(slots) else np.zeros(0, np.int64)
        return QuotientFilter(self.bits, slots[first], np.add.reduceat(counts, first) if len(first) else counts)

    @property
    def quotients(self) -> np.ndarray:
        return self.slots >> np.uint64(64 - self.bits) if self.bits else np.zeros_like(self.slots)

    @property
    def remainders(self) -> np.ndarray:
        return self.slots & np.uint64((1 << (64 - self.bits)) - 1)

    def blocks(self, block_bits: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """The runs, dealt into 2**block_bits blocks by the first bits of the quotient."""
        if not len(self.slots):
            return
        quotients, remainders = self.quotients, self.remainders
        block = quotients >> np.uint64(self.bits - block_bits)
        for part in np.split(np.arange(len(block)), np.flatnonzero(block[1:] != block[:-1]) + 1):
            yield (int(block[part[0]]), quotients[part].tobytes(), remainders[part].tobytes(),
                   self.counts[part].tobytes())

    @classmethod
    def from_block(cls, bits: int, quotients: bytes, remainders: bytes, counts: bytes) -> QuotientFilter:
        q, r = np.frombuffer(quotients, np.uint64), np.frombuffer(remainders, np.uint64)
        return cls(bits, (q << np.uint64(64 - bits)) | r if bits else r, np.frombuffer(counts, np.int64))


def _build(bits: int, block_bits: int):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        levels: list[QuotientFilter] = []  # of falling size, as a binary counter: each row is merged log n times
        for batch in batches:
            new = QuotientFilter.of(bits, batch["fingerprint"].to_numpy())
            while levels and len(levels[-1].slots) <= 2 * len(new.slots):
                new = levels.pop().merge(new)
            levels.append(new)
        whole = QuotientFilter.of(bits, np.zeros(0, np.uint64))
        while levels:
            whole = levels.pop().merge(whole)
        rows = list(whole.blocks(block_bits))
        for i in range(0, len(rows), 256):
            yield pd.DataFrame(rows[i:i + 256], columns=["block", "quotients", "remainders", "counts"])
    return build


def _merge(bits: int):
    def merge(runs: pd.DataFrame) -> pd.DataFrame:
        filters = [QuotientFilter.from_block(bits, *r) for r in
                   runs[["quotients", "remainders", "counts"]].itertuples(index=False, name=None)]
        while len(filters) > 1:
            filters = [a.merge(b) for a, b in zip(filters[::2], filters[1::2], strict=False)] + \
                ([filters[-1]] if len(filters) % 2 else [])
        many = filters[0].counts > 1
        return pd.DataFrame({"fingerprint": filters[0].slots[many].astype(np.int64),
                             "n": filters[0].counts[many]})
    return merge


def repeated_fingerprints(fingerprints: DataFrame, rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(fingerprint long, n long) of the values of column ``fingerprint`` that occur more than once."""
    block_bits = max(0, (max(rows, 1) - 1).bit_length() - (block_rows - 1).bit_length())
    bits = min(63, block_bits + 12)
    return (fingerprints.select("fingerprint").mapInPandas(_build(bits, block_bits), _RUNS)
            .groupBy("block").applyInPandas(_merge(bits), "fingerprint long, n long"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after each run of ASCII white space became one space; a null
    text counts as empty. The smallest doc_id of equal texts stays. Rows of the same doc_id and text
    count in group_size and are kept or dropped alike. A null doc_id stays only if its whole group
    has no id (keep_id is null then). An empty table gives no rows; other columns are not read.
    """
    texts = docs.select("doc_id", collapse_spaces(text_or_empty()).alias("norm"))
    marked = texts.withColumn("fingerprint", F.xxhash64("norm"))
    narrow = store(marked.select("doc_id", "fingerprint", F.sha2("norm", 256).alias("text_sha256")), "op8_marks")
    total = narrow.count()
    repeated = store(repeated_fingerprints(narrow, total), "op8_repeated")
    routed = left_join_hot(marked, repeated, ["fingerprint"], "n", total).filter("n IS NOT NULL")
    groups = (routed.groupBy("fingerprint", "norm")  # the bytes are compared here, after map-side combining
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .select("fingerprint", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"))
    joined = left_join_hot(narrow, store(groups, "op8_groups"), ["fingerprint", "text_sha256"], "group_size", total)
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
