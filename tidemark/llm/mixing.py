"""Mixing sources to target weights by temperature. DataFrame functions only.

Source weights are token shares raised to an exponent. The exponent is bisected until the weights
meet a target entropy, and no source repeats more often than a limit. A source's weight of the
token budget is then realised: whole seeded permutations of its documents, one per epoch, and the
first part of another. Places along each source's quota interleave the sources, so every block of
the mix has the weights, in a seeded order.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD, left_join_hot, store, text_or_empty

#: Production parameters: entropy as a share of log(sources); times a source may repeat; tokens of a block;
#: seed; budget in tokens as a multiple of the corpus.
TARGET_ENTROPY = 0.995
REPETITION_LIMIT = 4.0
BLOCK_TOKENS = 1 << 20
SEED = 17
BUDGET = 1.0

_POINTS = 15  # inner points evaluated at a time: four halvings
_ROUNDS = 10
_BUCKET_ROWS = 4096


def _evaluate(sources: DataFrame, total: int, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent, the entropy of the weights and the largest weight / share."""
    log_p = F.log(F.col("tokens") / F.lit(float(total)))
    sums = []
    for i, a in enumerate(exponents):
        sums += [F.sum(F.exp(log_p * a)).alias(f"z{i}"), F.sum(F.exp(log_p * a) * log_p).alias(f"s{i}"),
                 F.max(F.exp(log_p * (a - 1))).alias(f"m{i}")]
    row = sources.agg(*sums).first()
    return [(math.log(row[f"z{i}"]) - a * row[f"s{i}"] / row[f"z{i}"], row[f"m{i}"] / row[f"z{i}"])
            for i, a in enumerate(exponents)]


def solve_exponent(sources: DataFrame, total: int, n_sources: int, target_entropy: float | None,
                   repetition_limit: float | None, budget: float = BUDGET) -> float:
    """The exponent in [0, 1], to 6 decimals, by bisection over aggregates of ``sources`` (tokens > 0).

    With both goals the larger exponent holds, so the repetition limit is kept even where the
    entropy then falls short. 1 leaves the shares as they are, 0 makes all sources equal.
    """
    goals = []
    if target_entropy is not None:
        goals.append(lambda entropy, repeat: entropy >= target_entropy * math.log(n_sources))  # holds below the answer
    if repetition_limit is not None:
        goals.append(lambda entropy, repeat: repeat * budget > repetition_limit)
    if n_sources < 2 or not goals:
        return 1.0
    brackets = [(0.0, 1.0)] * len(goals)
    for _ in range(_ROUNDS):
        grids = [[lo + (hi - lo) * k / (_POINTS + 1) for k in range(_POINTS + 2)] for lo, hi in brackets]
        values = _evaluate(sources, total, [a for grid in grids for a in grid])
        for g, (goal, grid) in enumerate(zip(goals, grids, strict=True)):
            below = [goal(*v) for v in values[g * len(grid):(g + 1) * len(grid)]]
            k = below.index(False) if False in below else len(grid)
            brackets[g] = (grid[max(k - 1, 0)], grid[min(k, len(grid) - 1)])
    return round(max((lo + hi) / 2 for lo, hi in brackets), 6)


def mix(docs: DataFrame, target_entropy: float | None = TARGET_ENTROPY, repetition_limit: float | None = REPETITION_LIMIT,
        budget: float = BUDGET, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """One row per document drawn into the mix, and per epoch: doc_id, row_key, source, n_tokens, epoch,
    block, rank, quota.

    ``docs``: doc_id, text, source. Tokens are words. A document is a doc_id with a text; rows equal in
    both are one. (block, rank) is the order of the mix: a document is drawn in an epoch while
    less than its source's quota has been drawn, so a source's tokens reach the quota with its
    last document. A null source is a source of its own; null and empty texts have no tokens and cost
    nothing; a source without tokens gets no weight, and a table without tokens gives no rows.
    """
    source = F.col("source").cast("string")
    units = store(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), source.alias("source"),
                              F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("n_tokens"))
                  .groupBy("doc_id", "row_key").agg(F.min("source").alias("source"), F.max("n_tokens").alias("n_tokens"))
                  .withColumn("group", F.coalesce("source", F.lit("\0"))), "op2_units")
    sources = store(units.groupBy("group").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
                    .filter("tokens > 0"), "op2_sources")
    total, n_sources, n_docs = sources.agg(F.sum("tokens"), F.count(F.lit(1)), F.sum("n_docs")).first()
    total = total or 0
    exponent = solve_exponent(sources, total, n_sources, target_entropy, repetition_limit, budget) if total else 1.0
    spent = int(total * budget)
    powers = sources.withColumn("power", F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(exponent)))
    z = powers.agg(F.sum("power")).first()[0] or 1.0
    quotas = store(powers.withColumn("quota", F.floor(F.round(F.col("power") / F.lit(z) * F.lit(float(spent)), 3)).cast("long"))
                   .withColumn("whole", F.expr("quota div tokens")).withColumn("rest", F.col("quota") % F.col("tokens"))
                   .drop("power"), "op2_quotas")

    drawn = left_join_hot(units, quotas, ["group"], "n_docs", n_docs or 1).filter("quota > 0")
    epochs = F.sequence(F.lit(0).cast("long"), F.col("whole") - F.when(F.col("rest") > 0, 0).otherwise(1))
    copies = drawn.select("*", F.explode(epochs).alias("epoch"))
    bits = max(0, min(32, ((n_docs or 1) // _BUCKET_ROWS).bit_length()))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                .cast("binary"))
    copies = copies.withColumn("key", key).withColumn(
        "bucket", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), 32 - bits))
    within = ["group", "epoch", "bucket"]
    ordered = Window.partitionBy(*within).orderBy("key", "doc_id", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    local = copies.withColumn("before", F.coalesce(F.sum("n_tokens").over(ordered), F.lit(0)))
    sums = store(copies.groupBy(*within).agg(F.sum("n_tokens").alias("in_bucket")), "op2_buckets")
    offsets = sums.select(*within, F.coalesce(F.sum("in_bucket").over(
        Window.partitionBy("group", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("offset"))  # one row per bucket of _BUCKET_ROWS rows
    placed = local.join(offsets, within).withColumn("spent", F.col("offset") + F.col("before"))
    taken = placed.filter((F.col("epoch") < F.col("whole")) | (F.col("spent") < F.col("rest")))
    n_blocks = max(1, -(-spent // block_tokens))
    place = (F.col("epoch") * F.col("tokens") + F.col("spent")).cast("double") / F.col("quota") * F.lit(float(n_blocks))
    in_block = Window.partitionBy("block").orderBy("key", "doc_id", "row_key", "epoch")
    return (taken.withColumn("block", F.least(F.floor(place).cast("long"), F.lit(n_blocks - 1)))
            .withColumn("rank", F.row_number().over(in_block).cast("long"))
            .select("doc_id", "row_key", "source", "n_tokens", "epoch", "block", "rank", "quota"))


def realise(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs``, each as often as the mix draws it; rows equal in doc_id and text count once."""
    plan = mix(docs, **parameters).groupBy(F.col("row_key").alias("drawn_key"), F.col("doc_id").alias("drawn_id")).agg(
        F.count(F.lit(1)).alias("times"))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("row_key"),
                       F.col("doc_id").alias("row_id"))
    once = rows.join(plan, (F.col("row_key") == F.col("drawn_key")) & F.col("row_id").eqNullSafe(F.col("drawn_id")))
    return (once.dropDuplicates(["row_key", "row_id"])
            .select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*"))
