"""Positional operators without a single-task window.

``row_number()`` over an un-partitioned window (or one partitioned by a hot group) funnels every
row through one task. These operators get the same positions from value ranges instead:

1. A sample of the keys, drawn by hash, gives quantiles as range boundaries. The sample is an array in a
   scalar subquery: it runs with the query, in the cluster, and nothing is collected while the plan
   is built. Its size is bounded by the number of ranges, not by the rows.
2. A row's range is the number of boundaries at or below its key, found by binary search. It is a pure function of the row's values, so every branch of a plan agrees on it.
3. Rows per (range, group), combined map-side, give the rows of the group in earlier ranges, and
   ``row_number()`` inside a (range, group) gives the rest. Ranges are contiguous in the order, so all
   of them together have at most (groups + ranges) such pairs, and no pair is larger than a range.

Order columns must make the order total (unique keys), otherwise tied rows may swap positions between
runs (positions stay a valid 0..n-1 numbering).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SAMPLES_PER_RANGE = 16


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in order]


def _ranged(df: DataFrame, key: Column, n: int) -> DataFrame:
    """``df`` with ``__range``, the range (0..n) that ``key`` falls into."""
    keys = df.select(key.alias("__key"))
    wanted = n * _SAMPLES_PER_RANGE
    total = keys.agg(F.count(F.lit(1))).scalar()
    every = F.greatest(F.floor(total / F.lit(wanted)), F.lit(1))
    sample = (keys.withColumn("__every", every).filter(F.pmod(F.xxhash64("__key"), F.col("__every")) == 0)
              .agg(F.array_sort(F.collect_list("__key")).alias("__keys")))
    # Every so many of the sampled keys bounds a range; the number sampled varies about ``wanted``.
    step = F.greatest(F.ceil(F.size("__keys") / F.lit(float(n))), F.lit(1))
    bounds = sample.select(F.filter("__keys", lambda _, i: F.pmod(i + 1, step) == 0)).scalar()
    # Binary search: after each step that many of the (at most n) bounds are known to be at or below the key.
    found = df.withColumn("__key", key).withColumn("__range", F.lit(0))
    for width in [1 << b for b in reversed(range(n.bit_length()))]:
        at_or_below = F.get(bounds, F.col("__range") + (width - 1)) <= F.col("__key")
        found = found.withColumn("__range", F.col("__range") + F.when(at_or_below, width).otherwise(0))
    return found.drop("__key")


def rank_within(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str],
                name: str = "pos", num_ranges: int | None = None) -> DataFrame:
    """0-based position of each row inside its group, by ``order``; a hot group spreads over the ranges."""
    groups, order_cols = list(groups), _cols(order)
    n = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _ranged(df, F.struct(*groups, *order_cols), n)
    earlier = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy("__range", *groups).agg(F.count(F.lit(1)).alias("__n"))
              .select(F.col("__range").alias("__r"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
                      F.coalesce(F.sum("__n").over(earlier), F.lit(0)).cast("long").alias("__start")))
    local = F.row_number().over(Window.partitionBy("__range", *groups).orderBy(*order_cols)) - 1
    same = F.col("__range") == F.col("__r")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return (ranged.withColumn("__local", local).join(starts, same)
            .withColumn(name, F.col("__start") + F.col("__local"))
            .drop("__range", "__local", "__start", "__r", *[f"__g{i}" for i in range(len(groups))]))


def with_global_index(df: DataFrame, order: Sequence[Column | str], name: str = "idx",
                      num_ranges: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order``."""
    return rank_within(df, [], order, name, num_ranges)


def chunk_within(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str],
                 size: int, name: str = "chunk_no") -> DataFrame:
    """Slice each group, in ``order``, into consecutive chunks of ``size`` rows."""
    ranked = rank_within(df, groups, order, "__pos")
    return ranked.withColumn(name, F.floor(F.col("__pos") / size).cast("int")).drop("__pos")
