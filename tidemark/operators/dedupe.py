"""Keep one row per key across landed runs (the ``*_distinct`` views, W1-W7).

``row_number() = 1`` over a key window is planned by Catalyst as a partial
``WindowGroupLimit`` before the shuffle, so each map task forwards at most one
row per key: a key holding a third of all rows does not land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# Run recency orders.
#  "reference": ``ORDER BY dayId, runId DESC`` as the landing views are written
#               (DESC binds to runId only: the oldest day's last run wins, T1).
#  "latest":    newest day, newest run first (what the views' comment intends).
RECENCY = {
    "reference": (("dayId", "asc"), ("runId", "desc")),
    "latest": (("dayId", "desc"), ("runId", "desc")),
}


def recency_order(recency: str) -> list[Column]:
    return [F.asc(c) if d == "asc" else F.desc(c) for c, d in RECENCY[recency]]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               keep_null_keys: bool = False) -> DataFrame:
    """Rows ranked first per key by ``order``.

    With ``keep_null_keys`` rows whose key is NULL are all kept (a NULL key
    identifies nothing); otherwise they form one group, as SQL windows do.
    """
    keys = list(keys)
    rn = "__rn"
    ranked = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    if not keep_null_keys:
        return ranked.where(F.col(rn) == 1).drop(rn)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    firsts = ranked.where(F.col(rn) == 1).drop(rn).where(~null_key)
    return firsts.unionByName(df.where(null_key))


def dedupe_runs(df: DataFrame, keys: Sequence[str] | str, recency: str = "reference",
                ties: Sequence[str] = (), keep_null_keys: bool = False) -> DataFrame:
    """One row per key by run recency; ``ties`` (ascending, NULLs last) make it total."""
    if isinstance(keys, str):
        keys = [keys]
    order = [*recency_order(recency), *[F.asc_nulls_last(t) for t in ties]]
    return keep_first(df, keys, order, keep_null_keys)


#: Keys up to which their newest runs are broadcast: some 50 MB. They are counted first.
BROADCAST_KEYS = 500_000


def dedupe_newest(df: DataFrame, keys: Sequence[str] | str, ties: Sequence[str] = (), keep_null_keys: bool = False,
                  drop_null_keys: bool = False) -> DataFrame:
    """``dedupe_runs`` of recency "latest" for tables of many runs, where ranking would sort every row in its map task.

    Each key's newest run is found by a hash aggregate over keys and runs alone, and stored (nothing but their number reaches
    the driver, unless they are few enough to broadcast). Only rows of those runs are ranked. The join is by key and run and
    its result is ranked map-side first, so a key of many rows doesn't meet in one task. ``drop_null_keys`` leaves rows with a
    NULL key out, which saves reading ``df`` once more for them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    lowest = F.lit(-(1 << 31))  # NULLs come last in a falling order
    run = F.coalesce("dayId", lowest).cast("long") * F.lit(1 << 32) + F.coalesce("runId", lowest).cast("long")
    ensure_checkpoint_dir(df.sparkSession)
    newest = (df.where(known).groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
              .agg(F.max(run).alias("__newest")).checkpoint(eager=True))
    if newest.count() <= BROADCAST_KEYS:
        newest = F.broadcast(newest)
    same = run == F.col("__newest")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"__k{i}"))
    kept = df.where(known).join(newest, same, "left_semi")
    if drop_null_keys:
        return dedupe_runs(kept, keys, "latest", ties)
    if not keep_null_keys:
        return dedupe_runs(kept.unionByName(df.where(~known)), keys, "latest", ties)
    return dedupe_runs(kept, keys, "latest", ties).unionByName(df.where(~known))
