"""Request planning for the next load.

Fact requests: the companies of each request group, in symbol order, cut into
chunks of 99 symbols, each chunk asking for ``date_from`` = the group's high
water mark (inclusive: the boundary day is re-read and upserted) up to ``now``.
Everything is one DataFrame plan; chunking uses a range-partitioned index, so
an exchange holding a third of all companies is still spread across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import request_path, symbols_text
from tidemark.operators.incremental import companies_per_group, high_water_marks_from
from tidemark.operators.indexing import chunk_within
from tidemark.schemas import SYMBOLS_PER_REQUEST


def symbol_chunks(companies: DataFrame, size: int = SYMBOLS_PER_REQUEST) -> DataFrame:
    """(group_id, chunk_no, n_symbols, symbols) from (group_id, CompanyId, ExchangeId)."""
    chunked = chunk_within(companies, ["group_id"], ["CompanyId", "ExchangeId"], size)
    return (chunked.groupBy("group_id", "chunk_no")
            .agg(F.sort_array(F.collect_list("CompanyId")).alias("__syms"))
            .select("group_id", "chunk_no", F.size("__syms").cast("int").alias("n_symbols"),
                    symbols_text(F.col("__syms")).alias("symbols")))


def fact_requests(groups: DataFrame, dim_company: DataFrame, marks: DataFrame, endpoint: str,
                  history_start: str, now: str) -> DataFrame:
    """(group_id, chunk_no, symbols, date_from, date_to, path) for every request; ``marks`` are those of the fact table."""
    chunks = symbol_chunks(companies_per_group(dim_company, groups))
    starts = high_water_marks_from(groups, dim_company, marks, history_start)
    return (chunks.join(starts, "group_id")
            .select("group_id", "chunk_no", "symbols", "date_from",
                    F.lit(now).alias("date_to"),
                    request_path(endpoint, F.col("symbols"), F.col("date_from"), F.lit(now)).alias("path")))


# Request path of each dimension table.
DIM_PATHS = {"DimExchange": "exchanges", "DimCurrency": "currencies"}
COMPANY_PATH_PREFIX = "tickers?exchange="


def dim_requests(spark: SparkSession, tables: list[str], exchanges: DataFrame | None = None) -> DataFrame:
    """(table_name, exchange, path): companies are requested per exchange."""
    fixed = [(t, None, DIM_PATHS[t]) for t in tables if t in DIM_PATHS]
    unknown = [t for t in tables if t not in DIM_PATHS and t != "DimCompany"]
    if unknown:
        raise ValueError(f"no request path for dimension tables {unknown}")
    out = spark.createDataFrame(fixed, "table_name STRING, exchange STRING, path STRING")
    if "DimCompany" in tables:
        if exchanges is None:
            raise ValueError("DimCompany requests need the exchanges to list")
        per_exchange = exchanges.select(
            F.lit("DimCompany").alias("table_name"), F.col("ExchangeId").alias("exchange"),
            F.concat(F.lit(COMPANY_PATH_PREFIX), F.col("ExchangeId")).alias("path"))
        out = out.unionByName(per_exchange)
    return out
