"""Run bookkeeping over landing partitions.

Run ids are compared as numbers: ``SHOW PARTITIONS`` yields text, and text
order puts run ``9`` after run ``10`` (traps T2/T3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_partitions(show_partitions: DataFrame) -> DataFrame:
    """``dayId=20220701/runId=3`` rows -> (dayId INT, runId INT)."""
    parts = F.split(F.col("partition"), "/")
    value = lambda i: F.split(F.get(parts, i), "=").getItem(1)
    return show_partitions.select(value(0).cast("int").alias("dayId"),
                                  value(1).cast("int").alias("runId"))


def max_day_run(partitions: DataFrame) -> DataFrame:
    """One row (dayId, runId): the latest day and its latest run, numerically."""
    latest = F.max(F.struct("dayId", "runId")).alias("m")
    return partitions.agg(latest).select("m.dayId", "m.runId").where(F.col("dayId").isNotNull())


def next_run_ids(partitions: DataFrame, days: DataFrame, day_col: str = "dayId") -> DataFrame:
    """For each probe day: 1 + the day's highest run, or 1 for a new day."""
    last = partitions.groupBy("dayId").agg(F.max("runId").alias("__last"))
    probes = days.select(F.col(day_col).cast("int").alias("dayId")).distinct()
    return (probes.join(last, "dayId", "left")
            .select("dayId", F.coalesce(F.col("__last") + 1, F.lit(1)).cast("int").alias("next_run_id")))


def run_row_counts(landing: DataFrame) -> DataFrame:
    """Rows per (dayId, runId) partition."""
    return landing.groupBy("dayId", "runId").agg(F.count(F.lit(1)).alias("n_rows"))
