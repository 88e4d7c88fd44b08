"""Declared schemas: API records, landing tables, staging tables, calendar.

Fixed values: field names, order and types below must equal the market-data
API payloads and the table layouts the pipeline serves. JSON pages are read
with these schemas; nothing is inferred. The reader makes every field
nullable, so rows with a missing ``mic`` can be dropped by the flattener.
"""

from __future__ import annotations

from pyspark.sql.types import StructType, StructField, ArrayType, LongType

# --- Fixed values: API record schemas (one per endpoint) -------------------
RECORD_DDL = {
    "exchanges": (
        "name STRING, acronym STRING, mic STRING, country STRING, country_code STRING, "
        "city STRING, website STRING, "
        "timezone STRUCT<timezone: STRING, abbr: STRING, abbr_dst: STRING>, "
        "currency STRUCT<code: STRING, symbol: STRING, name: STRING>"
    ),
    "eod": (
        "open FLOAT, high FLOAT, low FLOAT, close FLOAT, volume FLOAT, "
        "adj_high STRING, adj_low STRING, adj_close FLOAT, adj_open STRING, adj_volume STRING, "
        "split_factor FLOAT, dividend FLOAT, symbol STRING, exchange STRING, date STRING"
    ),
    "intraday": (
        "open FLOAT, high FLOAT, low FLOAT, last FLOAT, close FLOAT, volume FLOAT, "
        "date STRING, symbol STRING, exchange STRING"
    ),
    "dividends": "date STRING, dividend FLOAT, symbol STRING",
    "splits": "date STRING, split_factor FLOAT, symbol STRING",
    "tickers": (
        "name STRING, symbol STRING, has_intraday BOOLEAN, has_eod BOOLEAN, country STRING, "
        "stock_exchange STRUCT<name: STRING, acronym: STRING, mic: STRING, country: STRING, "
        "country_code: STRING, city: STRING, website: STRING>"
    ),
    "currencies": "code STRING, symbol STRING, name STRING",
    "timezones": "timezone STRING, abbr STRING, abbr_dst STRING",
}

# --- Fixed values: landing tables (all partitioned by dayId, runId) --------
LANDING_DDL = {
    "DimCompany": (
        "name STRING, symbol STRING, has_intraday BOOLEAN, has_eod BOOLEAN, country STRING, "
        "exchangeMic STRING, exchangeAcronym STRING, pk STRING"
    ),
    "DimCurrency": "code STRING, symbol STRING, name STRING",
    "DimExchange": (
        "name STRING, acronym STRING, mic STRING, country STRING, country_code STRING, "
        "city STRING, website STRING, currencyCode STRING, timezoneName STRING, "
        "timezoneAbbr STRING, timezoneAbbrDst STRING"
    ),
    "FactDividends": "date STRING, dividend FLOAT, symbol STRING, pk STRING",
    "FactEod": (
        "open FLOAT, high FLOAT, low FLOAT, close FLOAT, volume FLOAT, adj_high STRING, "
        "adj_low STRING, adj_close FLOAT, adj_open STRING, adj_volume STRING, "
        "split_factor FLOAT, dividend FLOAT, symbol STRING, exchange STRING, date INT, pk STRING"
    ),
    "FactSplits": "date INT, split_factor FLOAT, symbol STRING, pk STRING",
    "FactIntraday": (
        "open FLOAT, high FLOAT, low FLOAT, last FLOAT, close FLOAT, volume FLOAT, "
        "date STRING, symbol STRING, exchange STRING"
    ),
}
RUN_PARTITION_COLUMNS = ("dayId", "runId")

# --- Fixed values: staging tables -------------------------------------------
STAGING_DDL = {
    "DimCompany": "PK STRING, CompanyId STRING, CompanyName STRING, ExchangeId STRING",
    "DimCurrency": "CurrencyId STRING, Symbol STRING, Name STRING",
    "DimExchange": (
        "ExchangeId STRING, Name STRING, Acronym STRING, Country STRING, CountryCode STRING, "
        "City STRING, Website STRING, TimezoneName STRING, TimezoneCode STRING, CurrencyId STRING"
    ),
    "FactDividends": "PK STRING, Symbol STRING, Dividend FLOAT, Date INT",
    "FactEod": (
        "PK STRING, Open FLOAT, High FLOAT, Low FLOAT, Close FLOAT, Volume FLOAT, "
        "SplitFactor FLOAT, Dividend FLOAT, Symbol STRING, ExchangeId STRING, Date INT"
    ),
    "FactSplits": "PK STRING, Symbol STRING, SplitFactor FLOAT, Date INT",
    "DimDate": (
        "DateNum INT, Date DATE, YearId INT, YearMonthNum INT, Calendar_Quarter STRING, "
        "MonthNum INT, MonthName STRING, MonthShortName STRING, WeekNum INT, DayNumOfYear INT, "
        "DayNumOfMonth INT, DayNumOfWeek INT, DayName STRING, DayShortName STRING, Quarter INT, "
        "YearQuarterNum INT, DayNumOfQuarter INT"
    ),
}
# Fact staging tables are laid out by their date key; dims are not partitioned.
STAGING_PARTITION = {"FactEod": "Date", "FactDividends": "Date", "FactSplits": "Date"}

# --- Fixed values: landing -> staging column mappings ------------------------
# {staging column: landing expression}; the rename is data, as in the config.
COLUMN_MAPPING = {
    "FactEod": {
        "PK": "pk", "Open": "open", "High": "high", "Low": "low", "Close": "close",
        "Volume": "volume", "SplitFactor": "split_factor", "Dividend": "dividend",
        "Symbol": "symbol", "ExchangeId": "exchange", "Date": "date",
    },
    "FactDividends": {"PK": "pk", "Symbol": "symbol", "Dividend": "dividend", "Date": "date"},
    "FactSplits": {"PK": "pk", "Symbol": "symbol", "SplitFactor": "split_factor", "Date": "date"},
    "DimCompany": {"PK": "pk", "CompanyId": "symbol", "CompanyName": "name", "ExchangeId": "exchangeMic"},
    "DimExchange": {
        "ExchangeId": "mic", "Name": "name", "Acronym": "acronym", "Country": "country",
        "CountryCode": "country_code", "City": "city", "Website": "website",
        "TimezoneName": "timezoneName", "TimezoneCode": "timezoneAbbr", "CurrencyId": "currencyCode",
    },
    "DimCurrency": {"CurrencyId": "code", "Symbol": "symbol", "Name": "name"},
}
COLUMN_MAPPING["DimDate"] = {c: c for c in
                             [f.split()[0] for f in STAGING_DDL["DimDate"].split(", ")]}

# Landing key per table and the staging key it maps to.
LANDING_KEY = {
    "FactEod": "pk", "FactDividends": "pk", "FactSplits": "pk",
    "DimCompany": "pk", "DimExchange": "mic", "DimCurrency": "code",
}
# The as-written distinct views partition DimCompany by symbol, not pk (trap T4).
DISTINCT_VIEW_KEY = dict(LANDING_KEY, DimCompany="symbol")
STAGING_KEY = {
    "FactEod": "PK", "FactDividends": "PK", "FactSplits": "PK", "DimCompany": "PK",
    "DimExchange": "ExchangeId", "DimCurrency": "CurrencyId", "DimDate": "DateNum",
}

# --- Fixed values: endpoint per landing table, flattener per endpoint -------
ENDPOINT_OF_TABLE = {
    "DimExchange": "exchanges", "FactEod": "eod", "DimCompany": "tickers",
    "DimCurrency": "currencies", "FactIntraday": "intraday",
    "FactDividends": "dividends", "FactSplits": "splits",
}

# API paging limits.
PAGE_SIZE = 1000          # records per page (API maximum)
SYMBOLS_PER_REQUEST = 99  # kept under the API's 100 symbols per request


def struct(ddl: str) -> StructType:
    """Parse a DDL column list into a StructType."""
    return StructType.fromDDL(ddl)


def record_schema(endpoint: str) -> StructType:
    return struct(RECORD_DDL[endpoint])


def page_schema(endpoint: str) -> StructType:
    """Envelope of one API page: ``{pagination: {total}, data: [record]}``."""
    return StructType([
        StructField("pagination", StructType([StructField("total", LongType())])),
        StructField("data", ArrayType(record_schema(endpoint))),
    ])


def landing_schema(table: str, with_run: bool = True) -> StructType:
    ddl = LANDING_DDL[table] + (", dayId INT, runId INT" if with_run else "")
    return struct(ddl)


def staging_schema(table: str) -> StructType:
    return struct(STAGING_DDL[table])


def staging_columns(table: str) -> list[str]:
    return [f.name for f in staging_schema(table).fields]


def landing_columns(table: str) -> list[str]:
    return [f.name for f in landing_schema(table, with_run=False).fields]
