"""Catalog views: the analytics layer over staging (V1-V8) and the landing tables' distinct views.

All are ``CREATE OR REPLACE VIEW`` over catalog tables, so they show what the tables hold when they are
queried, also after merges.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from tidemark.operators.dedupe import RECENCY
from tidemark.schemas import DISTINCT_VIEW_KEY, landing_columns

# name -> (staging tables it reads, query); {s} is the staging database.
ANALYTICS = {
    # A company's listing on the greatest exchange id that the exchange table knows, shown if it has a name. Listings are one per
    # exchange (staging key: company and exchange), so the greatest struct is that listing.
    "vw_DimCompany": (["DimCompany", "DimExchange"], """
        SELECT CompanyId, pick.CompanyName, pick.ExchangeId, pick.Country
        FROM (SELECT listed.CompanyId,
                     max(struct(known.ExchangeId, listed.CompanyName, known.Country)) AS pick
              FROM {s}.DimExchange AS known INNER JOIN {s}.DimCompany AS listed USING (ExchangeId)
              GROUP BY listed.CompanyId)
        WHERE pick.CompanyName IS NOT NULL"""),
    "vw_DimCompanyExchange": (["DimCompany"], """
        SELECT PK AS CompanyExchangeId, CompanyId, CompanyName, ExchangeId FROM {s}.DimCompany
        WHERE CompanyName IS NOT NULL"""),
    "vw_DimCurrency": (["DimCurrency"], "SELECT CurrencyId, Symbol, Name FROM {s}.DimCurrency"),
    "vw_DimDate": (["DimDate"], """
        SELECT *, concat(CAST(YearId AS STRING), ' Q', CAST(Quarter AS STRING)) AS YearAndQuarter FROM {s}.DimDate"""),
    "vw_DimExchange": (["DimExchange"], """
        SELECT ExchangeId, Name, Acronym, Country, CountryCode, City, Website, TimezoneName, TimezoneCode, CurrencyId
        FROM {s}.DimExchange"""),
    "vw_FactDividends": (["FactDividends"], "SELECT Symbol, Dividend, Date FROM {s}.FactDividends"),
    # Day ratios are DOUBLE; a zero divisor gives NULL, not an error.
    "vw_FactEod": (["FactEod"], """
        SELECT concat(Symbol, '_', ExchangeId) AS CompanyExchangeId, Symbol AS CompanyId, Open, High, Low, Close,
               Volume, SplitFactor, Dividend, ExchangeId, Date,
               try_divide(CAST(Close AS DOUBLE), CAST(Open AS DOUBLE)) - 1 AS OpenToCloseChange,
               try_divide(CAST(High AS DOUBLE), CAST(Low AS DOUBLE)) - 1 AS LowToHightChange
        FROM {s}.FactEod"""),
    "vw_FactSplits": (["FactSplits"], "SELECT Symbol, SplitFactor, Date FROM {s}.FactSplits"),
}


def create_analytics_views(spark: SparkSession, staging_db: str, analytics_db: str, location: str) -> list[str]:
    """``CREATE VIEW analytics_db.vw_*`` for every view whose staging tables exist; returns their full names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {analytics_db} LOCATION '{location}'")
    made = []
    for name, (tables, query) in ANALYTICS.items():
        if all(spark.catalog.tableExists(f"{staging_db}.{t}") for t in tables):
            spark.sql(f"CREATE OR REPLACE VIEW {analytics_db}.{name} AS {query.format(s=staging_db)}")
            made.append(f"{analytics_db}.{name}")
    return made


def distinct_view(database: str, table: str) -> str:
    return f"{database}.vw_{table}_distinct"


def tie_columns(table: str, key: str) -> list[str]:
    """Landing columns that order the rows of a key within a run: all but the key, so the order is total."""
    return [c for c in landing_columns(table) if c != key]


def create_distinct_views(spark: SparkSession, database: str, tables: Iterable[str]) -> list[str]:
    """``CREATE VIEW database.vw_<table>_distinct``: one landed row per key, in the order as written.

    Companies are keyed by symbol and come without ``pk`` (T4).
    """
    made = []
    for table in tables:
        key = DISTINCT_VIEW_KEY[table]
        order = [f"{c} {d.upper()}" for c, d in RECENCY["reference"]] + \
            [f"{c} ASC NULLS LAST" for c in tie_columns(table, key)]
        shown = [c for c in landing_columns(table) if table != "DimCompany" or c != "pk"]
        name = distinct_view(database, table)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(shown)} FROM (SELECT *, row_number() OVER "
                  f"(PARTITION BY {key} ORDER BY {', '.join(order)}) AS place FROM {database}.{table}) WHERE place = 1")
        made.append(name)
    return made
