"""Incremental planning over staging tables.

The driver-side list round trips of a hand-written loader (company list ->
SQL ``IN`` text -> fact query -> Python set difference) become joins: many
exchange groups are planned in one pass and nothing is collected.

``groups`` frames carry (``group_id``, ``ExchangeId``): one row per exchange
of a request group, so a group may span several exchanges.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import int_to_date


def parse_exchanges(exchanges: str | Iterable[str]) -> list[str]:
    """Config value -> exchange keys: ``"'XNAS', 'XNYS'"``, ``"XTAI"`` or a list."""
    if isinstance(exchanges, str):
        items = exchanges.split(",")
    else:
        items = list(exchanges)
    return [x.strip().strip("'\"").strip() for x in items if x.strip().strip("'\"").strip()]


def exchange_groups(spark: SparkSession, groups: dict[str, str | Iterable[str]]) -> DataFrame:
    """Request groups from config values: {group_id: exchanges}."""
    rows = [(g, x) for g, v in groups.items() for x in parse_exchanges(v)]
    return spark.createDataFrame(rows, "group_id STRING, ExchangeId STRING")


def companies_per_group(dim_company: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_id, CompanyId, ExchangeId) for every listing on a group's exchanges.

    Not distinct: a company listed on two exchanges of a group appears twice.
    """
    return (dim_company.select("CompanyId", "ExchangeId")
            .join(groups.select("group_id", "ExchangeId"), "ExchangeId")
            .select("group_id", "CompanyId", "ExchangeId"))


def companies_in(dim_company: DataFrame, exchanges: DataFrame) -> DataFrame:
    """``SELECT CompanyId FROM DimCompany WHERE ExchangeId IN (...)`` as a semi-join.

    An empty exchange list gives an empty result instead of a syntax error.
    """
    return (dim_company.join(exchanges.select("ExchangeId").distinct(), "ExchangeId", "left_semi")
            .select("CompanyId"))


def fact_symbols(fact: DataFrame) -> DataFrame:
    """Distinct symbols of a fact table (partial aggregation map-side)."""
    return fact.select("Symbol").distinct()


def fact_symbols_for(fact: DataFrame, companies: DataFrame) -> DataFrame:
    """Distinct fact symbols that are among ``companies``."""
    wanted = companies.select(F.col("CompanyId").alias("Symbol")).distinct()
    return fact_symbols(fact).join(wanted, "Symbol", "left_semi")


def missing_companies(companies: DataFrame, marks: DataFrame) -> DataFrame:
    """(group_id, CompanyId) of companies without a row in the fact table, which has a mark for each of its symbols."""
    present = marks.select(F.col("Symbol").alias("CompanyId"))
    return companies.select("group_id", "CompanyId").distinct().join(present, "CompanyId", "left_anti")


def _facts_of(fact: DataFrame, companies: DataFrame) -> DataFrame:
    wanted = companies.select(F.col("CompanyId").alias("Symbol")).distinct()
    return fact.join(wanted, "Symbol", "left_semi")


def max_date_per_symbol(fact: DataFrame) -> DataFrame:
    return fact.groupBy("Symbol").agg(F.max("Date").alias("max_date"))


def high_water_marks(groups: DataFrame, dim_company: DataFrame, fact: DataFrame,
                     history_start: str) -> DataFrame:
    """``high_water_marks_from`` marks taken from the fact rows of the groups' companies."""
    companies = companies_per_group(dim_company, groups)
    return high_water_marks_from(groups, dim_company, max_date_per_symbol(_facts_of(fact, companies)), history_start)


def high_water_marks_from(groups: DataFrame, dim_company: DataFrame, marks: DataFrame, history_start: str) -> DataFrame:
    """Start date of the next fact request per group, ``yyyy-MM-dd``.

    ``marks`` (Symbol, max_date) has one row per symbol. If any company of the group has no fact row: ``history_start``.
    Otherwise the least, over the group's companies, of each company's latest fact date (facts are matched on symbol
    only). A group without companies also starts at ``history_start``.
    """
    companies = companies_per_group(dim_company, groups)
    per_symbol = marks.select("Symbol", "max_date")
    starts = (companies.join(per_symbol, companies.CompanyId == per_symbol.Symbol, "left")
              .groupBy("group_id")
              .agg(F.max(F.col("max_date").isNull().cast("int")).alias("__missing"),
                   F.min("max_date").alias("__least")))
    start = F.when((F.col("__missing") == 1) | F.col("__least").isNull(), F.lit(history_start)) \
        .otherwise(int_to_date("__least"))
    return (groups.select("group_id").distinct()
            .join(starts, "group_id", "left")
            .select("group_id", start.alias("date_from")))
