"""Page planning and page assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.indexing import with_global_index
from tidemark.schemas import PAGE_SIZE


def page_requests(totals: DataFrame, total_col: str = "total", page_size: int = PAGE_SIZE) -> DataFrame:
    """One row per API call needed to read ``total`` records.

    ``total <= page_size``: a single call with ``limit = total`` (also for 0);
    otherwise calls of ``limit = page_size`` at offsets 0, page_size, ... while
    records remain. Adds ``page_no``, ``offset`` and ``limit``.
    """
    total = F.col(total_col)
    offsets = F.sequence(F.lit(0).cast("long"), F.greatest(total - 1, F.lit(0)).cast("long"),
                         F.lit(page_size).cast("long"))
    return (totals.withColumn("offset", F.explode(offsets))
            .withColumn("page_no", (F.col("offset") / page_size).cast("int"))
            .withColumn("limit", F.when(total <= page_size, total).otherwise(F.lit(page_size)).cast("long")))


def assign_pages(records: DataFrame, page_size: int = PAGE_SIZE,
                 order: Sequence[Column | str] | None = None, name: str = "page_no") -> DataFrame:
    """Give every record a page number; no page holds more than ``page_size``.

    With ``order`` pages are consecutive slices of that global order (page 0
    holds the first ``page_size`` records). Without it, pages are cut inside
    each Spark partition, which needs no sort at all.
    """
    if order is not None:
        indexed = with_global_index(records, order, "__idx")
        return indexed.withColumn(name, F.floor(F.col("__idx") / page_size).cast("long")).drop("__idx")
    pid = F.spark_partition_id().cast("long")
    local = F.monotonically_increasing_id() - F.shiftleft(pid, 33)
    return records.withColumn(name, F.shiftleft(pid, 33) + F.floor(local / page_size))
