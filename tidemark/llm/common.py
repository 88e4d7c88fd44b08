"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

# What counts as white space and as a word in every operator here.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: A key is hot if it holds 1/HOT_PARTS of all rows or more, so at most HOT_PARTS keys are hot.
HOT_PARTS = 256
_SALTS = 4096
#: Rows of a small table, and of a task that has a part of one.
FEW, FEW_ROWS = 1 << 18, 1 << 14


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``store``, and the number of rows, counted by the tasks that write them."""
    observed = Observation()
    stored = store(df.observe(observed, F.count(F.lit(1)).alias("n")), name)
    return stored, observed.get["n"]


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of ``rows`` rows; a table of few (FEW at the most) dealt by ``keys`` to as few tasks as it needs.

    What aggregates or joins it on the keys then starts no more tasks. Larger tables stay as they are.
    """
    return df.repartition(1 + rows // FEW_ROWS, *keys) if rows <= FEW else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def collapse_spaces(column: Column) -> Column:
    return F.regexp_replace(column, SPACES, " ")


def left_join_hot(left: DataFrame, right: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``keys``; no key's rows have to meet in one task.

    ``right`` has one row per key, and ``size`` says how many of ``total`` left rows the key has. Keys
    with ``total / HOT_PARTS`` rows or more are at most HOT_PARTS, so their rows of ``right`` are
    broadcast; their left rows get a salt that matches nothing and spreads them in the shuffle
    join of the other keys. ``right`` is read twice: pass a stored table. Null keys match nothing.
    """
    values = [c for c in right.columns if c not in keys]
    hot = F.col(size) * HOT_PARTS >= F.lit(total)
    few = right.filter(hot).select(*keys, F.struct(*values).alias("_hot"))
    # Always 0, but no literal: the optimizer would fold one out of the join keys, and with it the salt out of the shuffle.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    many = right.filter(~hot).select(*keys, zero.alias("_salt"), F.struct(*values).alias("_cold"))
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int") + 1
    alone = F.col("_hot").isNotNull()
    for key in keys:
        alone = alone | F.col(key).isNull()
    salted = (left.join(F.broadcast(few), keys, "left")
              .withColumn("_salt", F.when(alone, spread).otherwise(zero)))
    joined = salted.join(many, [*keys, "_salt"], "left")
    found = F.coalesce("_hot", "_cold")
    return joined.select(*left.columns, *[found[v].alias(v) for v in values])


def matched_hot(left: DataFrame, right: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """The rows of ``left_join_hot`` that found a row of ``right``; ``size`` must not be null there."""
    return left_join_hot(left, right, keys, size, total).filter(F.col(size).isNotNull())
