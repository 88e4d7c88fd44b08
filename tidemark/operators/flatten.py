"""Flatteners: one typed landing row per API record.

Input is a DataFrame of records (one column per record field, as produced by
``sources.pages.explode_pages``). Output columns are in landing-table order.
All work is projection over nested fields, so it fuses into the scan stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import api_day, date_key, key


def flatten_exchanges(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Lift currency/timezone fields out of their structs; drop rows with no mic."""
    return records.select(
        "name", "acronym", "mic", "country", "country_code", "city", "website",
        F.col("currency.code").alias("currencyCode"),
        F.col("timezone.timezone").alias("timezoneName"),
        F.col("timezone.abbr").alias("timezoneAbbr"),
        F.col("timezone.abbr_dst").alias("timezoneAbbrDst"),
        *keep,
    ).na.drop(subset=["mic"])


def flatten_eod(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Day as ``yyyyMMdd``; ``pk = symbol_exchange_day``; date as INT."""
    day = api_day("date")
    return records.select(
        "open", "high", "low", "close", "volume", "adj_high", "adj_low", "adj_close",
        "adj_open", "adj_volume", "split_factor", "dividend", "symbol", "exchange",
        date_key(day).alias("date"),
        key("symbol", "exchange", day).alias("pk"),
        *keep,
    )


def flatten_intraday(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed as sent; the timestamp text is kept."""
    return records.select("open", "high", "low", "last", "close", "volume", "date", "symbol", "exchange",
                          *keep)


def flatten_dividends(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Day stays TEXT ``yyyyMMdd`` in landing (cast to INT when merged)."""
    day = api_day("date")
    return records.select(day.alias("date"), "dividend", "symbol", key("symbol", day).alias("pk"), *keep)


def flatten_splits(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    day = api_day("date")
    return records.select(date_key(day).alias("date"), "split_factor", "symbol",
                          key("symbol", day).alias("pk"), *keep)


def flatten_companies(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Listing exchange out of ``stock_exchange``; ``pk = symbol_exchangeMic``."""
    return records.select(
        "name", "symbol", "has_intraday", "has_eod", "country",
        F.col("stock_exchange.mic").alias("exchangeMic"),
        F.col("stock_exchange.acronym").alias("exchangeAcronym"),
        key("symbol", F.col("stock_exchange.mic")).alias("pk"),
        *keep,
    )


def flatten_currencies(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return records.select("code", "symbol", "name", *keep)


def flatten_timezones(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return records.select("timezone", "abbr", "abbr_dst", *keep)


# Endpoint -> flattener.
FLATTENERS = {
    "exchanges": flatten_exchanges,
    "eod": flatten_eod,
    "tickers": flatten_companies,
    "currencies": flatten_currencies,
    "timezones": flatten_timezones,
    "intraday": flatten_intraday,
    "dividends": flatten_dividends,
    "splits": flatten_splits,
}


def flatten(records: DataFrame, endpoint: str, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten with the endpoint's flattener; ``keep`` columns pass through."""
    try:
        return FLATTENERS[endpoint](records, keep)
    except KeyError:
        raise ValueError(f"no flattener for endpoint {endpoint!r}") from None
