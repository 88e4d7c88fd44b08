"""Market-data inputs derived from the driver's tables (FIXTURES.md §4).

The market data themselves are not shipped, so each endpoint's records are
derived column by column from the TPC-H-ish tables. Every expression is a
built-in column function, so the derivation is a narrow projection of a
Parquet scan: it grows with the tables and runs in whole-stage codegen.

Columns named ``tie*`` exist only to break ties inside a run and are never
part of a landing table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The run each exchange/currency row belongs to.
DIM_RUNS = [1, 2, 10]
# Shared defaults of the derived scenario.
HISTORY_START = "1995-01-01"
NOW = "2022-07-03"
BAD_DATE_LINENUMBER = 5

EOD_TIES = ["tie1", "tie2", "tie3", "tie4"]
DIM_TIES = ["tie1"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("string")


def _sym(key: str, modulo: int) -> Column:
    return F.concat(F.lit("C"), _s(F.col(key) % modulo))


def _month(ts: str) -> Column:
    return F.date_trunc("month", F.col(ts))


def _yyyymmdd(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def _api_ts(ts: Column) -> Column:
    """The API's timestamp text, e.g. ``2022-07-06T00:00:00+0000``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+0000'")


def _runs(order_key: str, line_key: str) -> list[Column]:
    return [
        (F.lit(20220701) + F.col(order_key) % 3).cast("int").alias("dayId"),
        (F.lit(1) + (F.col(order_key) * 7 + F.col(line_key)) % 12).cast("int").alias("runId"),
    ]


def _line_ties() -> list[Column]:
    return [F.col("l_orderkey").alias("tie1"), F.col("l_linenumber").alias("tie2"),
            F.col("l_partkey").alias("tie3"), F.col("l_suppkey").alias("tie4")]


def fx_eod(spark: SparkSession, sf_dir: str, bad_dates: bool = False) -> DataFrame:
    """End-of-day prices, one per lineitem. ``date_raw`` is the API text."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    month = _month("l_shipdate")
    date_raw = _api_ts(month)
    if bad_dates:
        date_raw = F.when(F.col("l_linenumber") == BAD_DATE_LINENUMBER, F.lit("junk")).otherwise(date_raw)
    return li.select(
        F.when(F.col("l_linenumber") == 7, F.lit(0.0)).otherwise(price).cast("float").alias("open"),
        (price * F.lit(1.1)).cast("float").alias("high"),
        F.when(F.col("l_linenumber") == 6, F.lit(0.0)).otherwise(price * F.lit(0.9)).cast("float").alias("low"),
        (price * (F.lit(1) - F.col("l_discount"))).cast("float").alias("close"),
        F.col("l_quantity").cast("float").alias("volume"),
        _s(F.floor(price).cast("bigint")).alias("adj_high"),
        _s(F.floor("l_quantity").cast("bigint")).alias("adj_low"),
        price.cast("float").alias("adj_close"),
        _s("l_partkey").alias("adj_open"),
        _s("l_suppkey").alias("adj_volume"),
        (F.lit(1) + F.col("l_linenumber") % 3).cast("float").alias("split_factor"),
        F.col("l_tax").cast("float").alias("dividend"),
        _sym("l_partkey", 500).alias("symbol"),
        F.concat(F.lit("X"), _s(F.col("l_suppkey") % 5)).alias("exchange"),
        date_raw.alias("date_raw"),
        _yyyymmdd(month).cast("int").alias("date"),
        F.concat(_sym("l_partkey", 500), F.lit("_X"), _s(F.col("l_suppkey") % 5),
                 F.lit("_"), _yyyymmdd(month)).alias("pk"),
        *_runs("l_orderkey", "l_linenumber"),
        *_line_ties(),
    )


def fx_dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    month = _month("l_shipdate")
    return li.select(
        _yyyymmdd(month).alias("date"),
        F.col("l_tax").cast("float").alias("dividend"),
        _sym("l_partkey", 500).alias("symbol"),
        F.concat(_sym("l_partkey", 500), F.lit("_"), _yyyymmdd(month)).alias("pk"),
        _api_ts(month).alias("date_raw"),
        *_runs("l_orderkey", "l_linenumber"),
        *_line_ties(),
    )


def fx_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    month = _month("l_shipdate")
    return li.select(
        _yyyymmdd(month).cast("int").alias("date"),
        F.col("l_quantity").cast("float").alias("split_factor"),
        _sym("l_partkey", 500).alias("symbol"),
        F.concat(_sym("l_partkey", 500), F.lit("_"), _yyyymmdd(month)).alias("pk"),
        _api_ts(month).alias("date_raw"),
        *_runs("l_orderkey", "l_linenumber"),
        *_line_ties(),
    )


def fx_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers: one per customer; symbols C500-C509 have no fact rows."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    ck = F.col("c_custkey")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.when(ck % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("name"),
        _sym("c_custkey", 510).alias("symbol"),
        (ck % 2 == 0).alias("has_intraday"),
        (ck % 3 != 0).alias("has_eod"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("X"), _s("c_nationkey")).alias("exchangeMic"),
        F.concat(F.lit("A"), _s("c_nationkey")).alias("exchangeAcronym"),
        F.concat(_sym("c_custkey", 510), F.lit("_X"), _s("c_nationkey")).alias("pk"),
        (F.lit(20220701) + ck % 7 % 3).cast("int").alias("dayId"),
        (F.lit(1) + ck % 12).cast("int").alias("runId"),
        ck.alias("tie1"),
    )


def _dim_runs(df: DataFrame) -> DataFrame:
    """Replicate each row once per landed run (a bounded, fixed fan-out)."""
    return df.withColumn("run", F.explode(F.array(*[F.lit(r) for r in DIM_RUNS])))


def fx_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchanges, one per nation; nation 19's ``mic`` is null, and from 20 on it is one no company has."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    nk = F.col("n_nationkey")
    base = _dim_runs(nation.join(region, nation.n_regionkey == region.r_regionkey))
    return base.select(
        F.concat(F.col("n_name"), F.lit(" v"), _s("run")).alias("name"),
        F.concat(F.lit("A"), _s(nk)).alias("acronym"),
        F.when(nk == 19, F.lit(None).cast("string"))
        .otherwise(F.concat(F.when(nk >= 20, "Y").otherwise("X"), _s(nk))).alias("mic"),
        F.col("r_name").alias("country"),
        F.concat(F.lit("CC"), _s("n_regionkey")).alias("country_code"),
        F.concat(F.lit("City "), _s(nk)).alias("city"),
        F.concat(F.lit("www.x"), _s(nk), F.lit(".example")).alias("website"),
        F.concat(F.lit("CUR"), _s("n_regionkey")).alias("currencyCode"),
        F.concat(F.lit("Zone/"), F.col("r_name")).alias("timezoneName"),
        F.concat(F.lit("Z"), _s("n_regionkey")).alias("timezoneAbbr"),
        F.concat(F.lit("ZD"), _s("n_regionkey")).alias("timezoneAbbrDst"),
        (F.lit(20220701) + F.col("run") % 2).cast("int").alias("dayId"),
        F.col("run").cast("int").alias("runId"),
        nk.alias("tie1"),
    )


def fx_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = _dim_runs(table(spark, sf_dir, "region"))
    return region.select(
        F.concat(F.lit("CUR"), _s("r_regionkey")).alias("code"),
        F.concat(F.lit("$"), _s("r_regionkey")).alias("symbol"),
        F.concat(F.col("r_name"), F.lit(" v"), _s("run")).alias("name"),
        (F.lit(20220701) + F.col("run") % 2).cast("int").alias("dayId"),
        F.col("run").cast("int").alias("runId"),
        F.col("r_regionkey").alias("tie1"),
    )


def fx_timezone(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return region.select(
        F.concat(F.lit("Zone/"), F.col("r_name")).alias("timezone"),
        F.concat(F.lit("Z"), _s("r_regionkey")).alias("abbr"),
        F.concat(F.lit("ZD"), _s("r_regionkey")).alias("abbr_dst"),
    )


def fx_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    value = F.col("value")
    return ev.select(
        value.cast("float").alias("open"),
        (value + 1).cast("float").alias("high"),
        (value - 1).cast("float").alias("low"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(value).cast("float").alias("last"),
        value.cast("float").alias("close"),
        F.col("user_id").cast("float").alias("volume"),
        _api_ts(F.col("ts")).alias("date"),
        _sym("user_id", 500).alias("symbol"),
        F.concat(F.lit("X"), _s(F.col("user_id") % 5)).alias("exchange"),
        F.col("event_id").alias("tie1"),
    )


def calendar_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: first day of the first and last day of the last ship year."""
    li = table(spark, sf_dir, "lineitem")
    return li.agg(
        F.make_date(F.year(F.min("l_shipdate")), F.lit(1), F.lit(1)).alias("start"),
        F.make_date(F.year(F.max("l_shipdate")), F.lit(12), F.lit(31)).alias("end"),
    )


def record_struct(df: DataFrame, endpoint: str) -> Column:
    """The nested API record of a fixture row, as the endpoint would send it."""
    if endpoint == "exchanges":
        return F.struct(
            "name", "acronym", "mic", "country", "country_code", "city", "website",
            F.struct(F.col("timezoneName").alias("timezone"), F.col("timezoneAbbr").alias("abbr"),
                     F.col("timezoneAbbrDst").alias("abbr_dst")).alias("timezone"),
            F.struct(F.col("currencyCode").alias("code"), F.lit(None).cast("string").alias("symbol"),
                     F.lit(None).cast("string").alias("name")).alias("currency"),
        )
    if endpoint == "tickers":
        return F.struct(
            "name", "symbol", "has_intraday", "has_eod", "country",
            F.struct(F.lit(None).cast("string").alias("name"), F.col("exchangeAcronym").alias("acronym"),
                     F.col("exchangeMic").alias("mic"), F.col("country").alias("country"),
                     F.lit(None).cast("string").alias("country_code"),
                     F.lit(None).cast("string").alias("city"),
                     F.lit(None).cast("string").alias("website")).alias("stock_exchange"),
        )
    if endpoint == "eod":
        return F.struct(
            "open", "high", "low", "close", "volume", "adj_high", "adj_low", "adj_close",
            "adj_open", "adj_volume", "split_factor", "dividend", "symbol", "exchange",
            F.col("date_raw").alias("date"),
        )
    if endpoint in ("dividends", "splits"):
        value = "dividend" if endpoint == "dividends" else "split_factor"
        return F.struct(F.col("date_raw").alias("date"), value, "symbol")
    if endpoint == "intraday":
        return F.struct("open", "high", "low", "last", "close", "volume", "date", "symbol", "exchange")
    if endpoint == "currencies":
        return F.struct("code", "symbol", "name")
    if endpoint == "timezones":
        return F.struct("timezone", "abbr", "abbr_dst")
    raise ValueError(f"unknown endpoint {endpoint!r}")


FIXTURE_OF_ENDPOINT = {
    "eod": fx_eod, "dividends": fx_dividends, "splits": fx_splits, "tickers": fx_company,
    "exchanges": fx_exchange, "currencies": fx_currency, "timezones": fx_timezone,
    "intraday": fx_intraday,
}
TIES_OF_ENDPOINT = {
    "eod": EOD_TIES, "dividends": EOD_TIES, "splits": EOD_TIES, "tickers": DIM_TIES,
    "exchanges": DIM_TIES + ["runId"], "currencies": DIM_TIES + ["runId"],
    "timezones": ["timezone"], "intraday": DIM_TIES,
}


# The landing table of each endpoint that requests are answered from.
TABLE_OF_ENDPOINT = {"eod": "FactEod", "dividends": "FactDividends", "splits": "FactSplits", "tickers": "DimCompany",
                     "exchanges": "DimExchange", "currencies": "DimCurrency"}


def current_state(spark: SparkSession, sf_dir: str, endpoint: str) -> DataFrame:
    """What the API would answer today: every key's newest fixture row."""
    from tidemark.operators.dedupe import dedupe_newest  # local: fixtures stay import-light
    from tidemark.plans.views import tie_columns
    from tidemark.schemas import LANDING_KEY

    table_ = TABLE_OF_ENDPOINT[endpoint]
    key = LANDING_KEY[table_]
    return dedupe_newest(FIXTURE_OF_ENDPOINT[endpoint](spark, sf_dir), key, tie_columns(table_, key), drop_null_keys=True)


def land_answers(spark: SparkSession, sf_dir: str, table: str, endpoint: str, requests: DataFrame, root: str,
                 fetched_at: int = 1) -> None:
    """What a fetcher would land under ``root`` for ``requests``: the pages of their records.

    Fact requests get the current rows of their symbols whose day lies in ``[date_from, date_to]``;
    dimension requests get the current dimension, companies those of the request's exchange. A request
    without records gets an empty page.
    """
    from tidemark.schemas import LANDING_KEY
    from tidemark.session import delete_path, shared_dir
    from tidemark.sources.pages import build_pages, write_fetched

    # Ranking and counting the records reads them many times over, so the tables are read and deduped once, before. As a
    # file the requests have a known size: few are broadcast, and the records stay where they are.
    staged_at = shared_dir(spark, "current")
    try:
        current_state(spark, sf_dir, endpoint).write.parquet(f"{staged_at}/records", compression="zstd")
        requests.write.parquet(f"{staged_at}/requests", compression="zstd")
        current, requests = spark.read.parquet(f"{staged_at}/records"), spark.read.parquet(f"{staged_at}/requests")
        if endpoint in ("eod", "dividends", "splits"):
            wanted = requests.select(
                "path", F.explode(F.split("symbols", ", ")).alias("symbol"),
                F.regexp_replace("date_from", "-", "").cast("int").alias("__from"),
                F.regexp_replace("date_to", "-", "").cast("int").alias("__to"))
            day = F.regexp_replace(F.substring("date_raw", 1, 10), "-", "").cast("int")
            rows = (current.join(wanted, "symbol")
                    .where((day >= F.col("__from")) & (day <= F.col("__to"))))
        elif endpoint == "tickers":
            rows = current.join(requests.select("path", F.col("exchange").alias("exchangeMic")), "exchangeMic")
        else:  # whole-dimension endpoints answer one request
            rows = current.withColumn("path", F.lit(endpoint))
        pages = build_pages(rows, record_struct(rows, endpoint), group=["path"], order=[LANDING_KEY[table]])
        nothing = requests.select("path").distinct().join(rows.select("path").distinct(), "path", "left_anti")
        empty = nothing.select("path", F.lit(0).cast("long").alias("page_no"),
                               F.lit('{"pagination": {"total": 0}, "data": []}').alias("page"))
        answered = requests.select("path").unionByName(rows.select("path"))
        write_fetched(pages.unionByName(empty), f"{root}/{table}", fetched_at, answered=answered)
    finally:
        delete_path(spark, staged_at)
