"""Independent SQL (DuckDB dialect) for every registered query.

Written from the operator semantics, not from the Spark code: the fixture
derivations are restated in SQL, dedupe is a window, merge is ``UNION ALL``
of the updates and the anti-joined destination. Dialect notes: ``||`` (not
``concat``) keeps NULL-propagation; FLOAT is cast to DOUBLE before any
division or output; integer division is ``//``.
"""

from __future__ import annotations

# --------------------------------------------------------------------------- fixtures

_MONTH = "date_trunc('month', l_shipdate)"
_RUNS = ("CAST(20220701 + l_orderkey % 3 AS INT) AS dayId, "
         "CAST(1 + (l_orderkey * 7 + l_linenumber) % 12 AS INT) AS runId, "
         "l_orderkey AS tie1, l_linenumber AS tie2, l_partkey AS tie3, l_suppkey AS tie4")


def _eod(bad: bool = False) -> str:
    raw = f"strftime({_MONTH}, '%Y-%m-%dT00:00:00+0000')"
    day = f"strftime({_MONTH}, '%Y%m%d')"
    if bad:
        date = f"CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST({day} AS INT) END"
        pk = (f"CASE WHEN l_linenumber = 5 THEN NULL ELSE "
              f"'C' || (l_partkey % 500) || '_X' || (l_suppkey % 5) || '_' || {day} END")
        raw = f"CASE WHEN l_linenumber = 5 THEN 'junk' ELSE {raw} END"
    else:
        date = f"CAST({day} AS INT)"
        pk = f"'C' || (l_partkey % 500) || '_X' || (l_suppkey % 5) || '_' || {day}"
    return f"""
SELECT CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE l_extendedprice END AS FLOAT) AS open,
       CAST(l_extendedprice * 1.1 AS FLOAT) AS high,
       CAST(CASE WHEN l_linenumber = 6 THEN 0 ELSE l_extendedprice * 0.9 END AS FLOAT) AS low,
       CAST(l_extendedprice * (1 - l_discount) AS FLOAT) AS close,
       CAST(l_quantity AS FLOAT) AS volume,
       CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS adj_high,
       CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS adj_low,
       CAST(l_extendedprice AS FLOAT) AS adj_close,
       CAST(l_partkey AS VARCHAR) AS adj_open,
       CAST(l_suppkey AS VARCHAR) AS adj_volume,
       CAST(1 + l_linenumber % 3 AS FLOAT) AS split_factor,
       CAST(l_tax AS FLOAT) AS dividend,
       'C' || (l_partkey % 500) AS symbol,
       'X' || (l_suppkey % 5) AS exchange,
       {raw} AS date_raw,
       {date} AS date,
       {pk} AS pk,
       {_RUNS}
FROM lineitem"""


FX = {
    "fx_eod": _eod(),
    "fx_eod_bad": _eod(bad=True),
    "fx_dividends": f"""
SELECT strftime({_MONTH}, '%Y%m%d') AS date, CAST(l_tax AS FLOAT) AS dividend,
       'C' || (l_partkey % 500) AS symbol,
       'C' || (l_partkey % 500) || '_' || strftime({_MONTH}, '%Y%m%d') AS pk, {_RUNS}
FROM lineitem""",
    "fx_splits": f"""
SELECT CAST(strftime({_MONTH}, '%Y%m%d') AS INT) AS date, CAST(l_quantity AS FLOAT) AS split_factor,
       'C' || (l_partkey % 500) AS symbol,
       'C' || (l_partkey % 500) || '_' || strftime({_MONTH}, '%Y%m%d') AS pk, {_RUNS}
FROM lineitem""",
    "fx_company": """
SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS name,
       'C' || (c_custkey % 510) AS symbol, c_custkey % 2 = 0 AS has_intraday,
       c_custkey % 3 <> 0 AS has_eod, n_name AS country, 'X' || c_nationkey AS exchangeMic,
       'A' || c_nationkey AS exchangeAcronym, 'C' || (c_custkey % 510) || '_X' || c_nationkey AS pk,
       CAST(20220701 + c_custkey % 7 % 3 AS INT) AS dayId, CAST(1 + c_custkey % 12 AS INT) AS runId,
       c_custkey AS tie1
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_exchange_all": """
SELECT n_name || ' v' || run AS name, 'A' || n_nationkey AS acronym,
       CASE WHEN n_nationkey = 19 THEN NULL WHEN n_nationkey >= 20 THEN 'Y' || n_nationkey
            ELSE 'X' || n_nationkey END AS mic,
       r_name AS country, 'CC' || n_regionkey AS country_code, 'City ' || n_nationkey AS city,
       'www.x' || n_nationkey || '.example' AS website, 'CUR' || n_regionkey AS currencyCode,
       'Zone/' || r_name AS timezoneName, 'Z' || n_regionkey AS timezoneAbbr,
       'ZD' || n_regionkey AS timezoneAbbrDst, CAST(20220701 + run % 2 AS INT) AS dayId,
       CAST(run AS INT) AS runId, n_nationkey AS tie1
FROM nation JOIN region ON n_regionkey = r_regionkey
     CROSS JOIN (SELECT unnest([1, 2, 10]) AS run)""",
    "fx_exchange": "SELECT * FROM fx_exchange_all WHERE mic IS NOT NULL",
    "fx_currency": """
SELECT 'CUR' || r_regionkey AS code, '$' || r_regionkey AS symbol, r_name || ' v' || run AS name,
       CAST(20220701 + run % 2 AS INT) AS dayId, CAST(run AS INT) AS runId, r_regionkey AS tie1
FROM region CROSS JOIN (SELECT unnest([1, 2, 10]) AS run)""",
    "fx_timezone": """
SELECT 'Zone/' || r_name AS timezone, 'Z' || r_regionkey AS abbr, 'ZD' || r_regionkey AS abbr_dst
FROM region""",
    "fx_intraday": """
SELECT CAST(value AS FLOAT) AS open, CAST(value + 1 AS FLOAT) AS high, CAST(value - 1 AS FLOAT) AS low,
       CAST(CASE WHEN event_type = 'error' THEN NULL ELSE value END AS FLOAT) AS last,
       CAST(value AS FLOAT) AS close, CAST(user_id AS FLOAT) AS volume,
       strftime(ts, '%Y-%m-%dT%H:%M:%S+0000') AS date, 'C' || (user_id % 500) AS symbol,
       'X' || (user_id % 5) AS exchange
FROM events""",
    "fx_calendar": """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS DateNum, d AS Date, CAST(year(d) AS INT) AS YearId,
       CAST(year(d) * 100 + month(d) AS INT) AS YearMonthNum,
       'Q' || quarter(d) || '-' || year(d) AS Calendar_Quarter, CAST(month(d) AS INT) AS MonthNum,
       strftime(d, '%B') AS MonthName, strftime(d, '%b') AS MonthShortName,
       CAST(weekofyear(d) AS INT) AS WeekNum, CAST(dayofyear(d) AS INT) AS DayNumOfYear,
       CAST(day(d) AS INT) AS DayNumOfMonth, CAST(isodow(d) AS INT) AS DayNumOfWeek,
       strftime(d, '%A') AS DayName, strftime(d, '%a') AS DayShortName,
       CAST(quarter(d) AS INT) AS Quarter, CAST(year(d) * 10 + quarter(d) AS INT) AS YearQuarterNum,
       CAST(date_diff('day', CAST(date_trunc('quarter', d) AS DATE), d) + 1 AS INT) AS DayNumOfQuarter
FROM (SELECT CAST(unnest(generate_series(
          CAST(make_date(year(min(l_shipdate)), 1, 1) AS TIMESTAMP),
          CAST(make_date(year(max(l_shipdate)), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM lineitem)""",
}

# table -> (fixture view, landing key, tie columns, landing columns, staging mapping)
EOD_COLS = ["open", "high", "low", "close", "volume", "adj_high", "adj_low", "adj_close", "adj_open",
            "adj_volume", "split_factor", "dividend", "symbol", "exchange", "date", "pk"]
TABLES = {
    "FactEod": ("fx_eod", "pk", "tie1, tie2, tie3, tie4", EOD_COLS,
                "pk AS PK, CAST(open AS DOUBLE) AS Open, CAST(high AS DOUBLE) AS High, "
                "CAST(low AS DOUBLE) AS Low, CAST(close AS DOUBLE) AS Close, "
                "CAST(volume AS DOUBLE) AS Volume, CAST(split_factor AS DOUBLE) AS SplitFactor, "
                "CAST(dividend AS DOUBLE) AS Dividend, symbol AS Symbol, exchange AS ExchangeId, "
                "date AS Date"),
    "FactDividends": ("fx_dividends", "pk", "tie1, tie2, tie3, tie4", ["date", "dividend", "symbol", "pk"],
                      "pk AS PK, symbol AS Symbol, CAST(dividend AS DOUBLE) AS Dividend, "
                      "TRY_CAST(date AS INT) AS Date"),
    "FactSplits": ("fx_splits", "pk", "tie1, tie2, tie3, tie4", ["date", "split_factor", "symbol", "pk"],
                   "pk AS PK, symbol AS Symbol, CAST(split_factor AS DOUBLE) AS SplitFactor, date AS Date"),
    "DimCompany": ("fx_company", "pk", "tie1",
                   ["name", "symbol", "has_intraday", "has_eod", "country", "exchangeMic",
                    "exchangeAcronym", "pk"],
                   "pk AS PK, symbol AS CompanyId, name AS CompanyName, exchangeMic AS ExchangeId"),
    "DimExchange": ("fx_exchange", "mic", "tie1",
                    ["name", "acronym", "mic", "country", "country_code", "city", "website",
                     "currencyCode", "timezoneName", "timezoneAbbr", "timezoneAbbrDst"],
                    "mic AS ExchangeId, name AS Name, acronym AS Acronym, country AS Country, "
                    "country_code AS CountryCode, city AS City, website AS Website, "
                    "timezoneName AS TimezoneName, timezoneAbbr AS TimezoneCode, "
                    "currencyCode AS CurrencyId"),
    "DimCurrency": ("fx_currency", "code", "tie1", ["code", "symbol", "name"],
                    "code AS CurrencyId, symbol AS Symbol, name AS Name"),
}


def _by_value(cols: list[str], key: str) -> str:
    """Rows of a key within a run go by their other columns, NULLs last."""
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols if c != key)


TABLES = {t: (v, key, _by_value(cols, key), cols, mapping) for t, (v, key, _, cols, mapping) in TABLES.items()}
STAGING_KEY = {"FactEod": "PK", "FactDividends": "PK", "FactSplits": "PK", "DimCompany": "PK",
               "DimExchange": "ExchangeId", "DimCurrency": "CurrencyId"}

RECENCY = {"reference": "dayId, runId DESC", "latest": "dayId DESC, runId DESC"}


def _dedupe(source: str, key: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS __rn FROM {source}) WHERE __rn = 1")


def _latest(source: str) -> str:
    """The latest run's (dayId, runId), numerically."""
    return (f"(SELECT dayId, max(runId) AS runId FROM {source} "
            f"WHERE dayId = (SELECT max(dayId) FROM {source}) GROUP BY dayId)")


def _with(ctes: dict[str, str], body: str) -> str:
    """Prefix the fixtures a query needs (in dependency order) as CTEs."""
    parts = [f"{name} AS ({sql})" for name, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _fx(*names: str) -> dict[str, str]:
    out = {}
    for n in names:
        if n == "fx_exchange":
            out["fx_exchange_all"] = FX["fx_exchange_all"]
        out[n] = FX[n]
    return out


def _dbl(cols: list[str], floats: set[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in floats else c for c in cols)


EOD_FLOATS = {"open", "high", "low", "close", "volume", "adj_close", "split_factor", "dividend"}


def _staged(table: str) -> dict[str, str]:
    """CTEs ending in ``stg_<table>``: every key's newest row, mapped."""
    fxv, key, ties, _, mapping = TABLES[table]
    ctes = _fx(fxv)
    ctes[f"stg_{table}"] = f"SELECT {mapping} FROM ({_dedupe(fxv, key, RECENCY['latest'] + ', ' + ties)})"
    return ctes


def _merge(table: str, full: bool = False, unmapped: str | None = None, bad: bool = False) -> str:
    fxv, key, ties, cols, mapping = TABLES[table]
    skey = STAGING_KEY[table]
    ctes = _fx(fxv, "fx_eod_bad") if bad else _fx(fxv)
    ctes["lr"] = _latest(fxv)
    ctes["rest"] = f"SELECT * FROM {fxv} WHERE NOT (dayId = (SELECT dayId FROM lr) AND runId = (SELECT runId FROM lr))"
    ctes["before"] = f"SELECT {mapping} FROM ({_dedupe('rest', key, RECENCY['latest'] + ', ' + ties)})"
    if full:
        src = _dedupe(fxv, key, RECENCY["reference"] + ", " + ties)
    elif bad:
        run = ("SELECT * FROM fx_eod_bad WHERE dayId = (SELECT dayId FROM lr) "
               "AND runId = (SELECT runId FROM lr)")
        src = (f"SELECT * FROM ({_dedupe(f'({run}) WHERE pk IS NOT NULL', key, ties)}) "
               f"UNION ALL SELECT * FROM ({run}) WHERE pk IS NULL")
    else:
        src = _dedupe(f"(SELECT * FROM {fxv} WHERE dayId = (SELECT dayId FROM lr) "
                      f"AND runId = (SELECT runId FROM lr))", key, RECENCY["latest"] + ", " + ties)
    ctes["upd"] = f"SELECT {mapping} FROM ({src})"
    keep = (f"SELECT * FROM before b WHERE NOT EXISTS "
            f"(SELECT 1 FROM upd u WHERE u.{skey} = b.{skey})")
    if unmapped is None:
        return _with(ctes, f"SELECT * FROM upd UNION ALL {keep}")
    upd_cols = [c.split(" AS ")[-1] for c in mapping.split(", ")]
    sel = ", ".join(f"b.{c} AS {c}" if c == unmapped else f"u.{c} AS {c}" for c in upd_cols)
    return _with(ctes, f"SELECT {sel} FROM upd u LEFT JOIN before b ON u.{skey} = b.{skey} "
                       f"UNION ALL {keep}")


def _distinct(table: str, key: str, recency: str = "reference", drop_pk: bool = False) -> str:
    fxv, _, _, cols, _ = TABLES[table]
    ties = _by_value(cols, key)
    out = [c for c in cols if not (drop_pk and c == "pk")]
    floats = EOD_FLOATS | {"dividend", "split_factor"}
    return _with(_fx(fxv), f"SELECT {_dbl(out, floats)} FROM ({_dedupe(fxv, key, RECENCY[recency] + ', ' + ties)})")


def _groups() -> str:
    """Every exchange of the company dimension as a group, plus group 'ALL'."""
    return ("SELECT DISTINCT ExchangeId AS group_id, ExchangeId FROM stg_DimCompany "
            "UNION ALL SELECT DISTINCT 'ALL' AS group_id, ExchangeId FROM stg_DimCompany")


def _hwm_ctes() -> dict[str, str]:
    ctes = {**_staged("DimCompany"), **_staged("FactEod")}
    ctes["grp"] = _groups()
    ctes["comp"] = ("SELECT g.group_id, c.CompanyId, c.ExchangeId FROM stg_DimCompany c "
                    "JOIN grp g ON c.ExchangeId = g.ExchangeId")
    ctes["symmax"] = "SELECT Symbol, max(Date) AS max_date FROM stg_FactEod GROUP BY Symbol"
    ctes["hwm"] = """
SELECT c.group_id,
       CASE WHEN bool_or(s.max_date IS NULL) THEN '1995-01-01'
            ELSE strftime(strptime(CAST(min(s.max_date) AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') END AS date_from
FROM comp c LEFT JOIN symmax s ON c.CompanyId = s.Symbol GROUP BY c.group_id"""
    ctes["chunks"] = """
SELECT group_id, CAST(chunk_no AS INT) AS chunk_no, CAST(count(*) AS INT) AS n_symbols,
       string_agg(CompanyId, ', ' ORDER BY CompanyId) AS symbols
FROM (SELECT group_id, CompanyId,
             (row_number() OVER (PARTITION BY group_id ORDER BY CompanyId, ExchangeId) - 1) // 99 AS chunk_no
      FROM comp)
GROUP BY group_id, chunk_no"""
    return ctes


def _view(table_ctes: dict[str, str], body: str) -> str:
    return _with(table_ctes, body)


def _calendar() -> dict[str, str]:
    return {"stg_DimDate": FX["fx_calendar"]}


def _eod_landing_runs() -> str:
    return "SELECT dayId, runId, count(*) AS n_rows FROM fx_eod GROUP BY dayId, runId"


def _load_eod() -> dict[str, str]:
    return {**_staged("DimCompany"), **_staged("FactEod"),
            "loaded_eod": "SELECT * FROM stg_FactEod WHERE Symbol IN (SELECT CompanyId FROM stg_DimCompany)"}


def _merge_without_date() -> str:
    """Dividends merged without a date in the mapping: matched rows keep theirs, new ones have none."""
    fxv, key, ties, _, mapping = TABLES["FactDividends"]
    ctes = _fx(fxv)
    ctes["lr"] = _latest(fxv)
    run = "dayId = (SELECT dayId FROM lr) AND runId = (SELECT runId FROM lr)"
    order = RECENCY["latest"] + ", " + ties
    ctes["before"] = f"SELECT {mapping} FROM ({_dedupe(f'(SELECT * FROM {fxv} WHERE NOT ({run}))', key, order)})"
    ctes["upd"] = f"SELECT {mapping} FROM ({_dedupe(f'(SELECT * FROM {fxv} WHERE {run})', key, order)})"
    return _with(ctes, "SELECT u.PK, u.Symbol, u.Dividend, b.Date FROM upd u LEFT JOIN before b ON u.PK = b.PK "
                       "UNION ALL SELECT PK, Symbol, Dividend, Date FROM before b WHERE NOT EXISTS "
                       "(SELECT 1 FROM upd u WHERE u.PK = b.PK)")


def _merge_by_symbol() -> str:
    """Splits keyed by symbol: the latest run's newest row replaces the one before."""
    fxv, _, _, cols, mapping = TABLES["FactSplits"]
    mapping = mapping.replace("pk AS PK", "symbol AS PK")
    ctes = _fx(fxv)
    ctes["lr"] = _latest(fxv)
    run = "dayId = (SELECT dayId FROM lr) AND runId = (SELECT runId FROM lr)"
    order = RECENCY["latest"] + ", " + _by_value(cols, "symbol")
    ctes["before"] = f"SELECT {mapping} FROM ({_dedupe(f'(SELECT * FROM {fxv} WHERE NOT ({run}))', 'symbol', order)})"
    ctes["upd"] = f"SELECT {mapping} FROM ({_dedupe(f'(SELECT * FROM {fxv} WHERE {run})', 'symbol', order)})"
    return _with(ctes, "SELECT * FROM upd UNION ALL SELECT * FROM before b WHERE NOT EXISTS "
                       "(SELECT 1 FROM upd u WHERE u.PK = b.PK)")


def _landed_counts() -> str:
    tables = ["FactEod", "FactDividends", "FactSplits", "DimCompany", "DimExchange", "DimCurrency"]
    return _with(_fx(*[TABLES[t][0] for t in tables]), " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'landing/{t}' AS location, count(*) AS n_rows FROM {TABLES[t][0]}" for t in tables))


def _content(table: str, cols: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols)
    return f"SELECT '{table}' AS table_name, {text} AS content FROM "


ORACLES: dict[str, str] = {
    "page_explode": _with(_fx("fx_eod"), "SELECT " + _dbl(
        EOD_COLS[:14], EOD_FLOATS) + ", date_raw AS date FROM fx_eod"),
    "page_totals": _with(_fx("fx_eod"), """
SELECT CAST((rn - 1) // 1000 AS BIGINT) AS page_no, (SELECT count(*) FROM fx_eod) AS total,
       count(*) AS n_records
FROM (SELECT row_number() OVER (ORDER BY tie1, tie2, tie3, tie4) AS rn FROM fx_eod)
GROUP BY 1"""),
    "page_quarantine": _with({**_fx("fx_eod"), "paged": """
SELECT pk, CAST((row_number() OVER (ORDER BY tie1, tie2, tie3, tie4) - 1) // 1000 AS BIGINT) AS page_no FROM fx_eod"""}, """
SELECT 'landed' AS side, pk AS name, NULL AS page, 20220703 AS dayId, 1 AS runId FROM paged WHERE page_no % 3 <> 1
UNION ALL SELECT DISTINCT 'quarantined', 'eod?page=' || page_no, '{"error": {"code": "rate_limit_reached"}}', 20220703, 1
FROM paged WHERE page_no % 3 = 1"""),
    "page_requests": _with({**_fx("fx_eod"), "t": """
SELECT exchange || '_' || CAST(date AS VARCHAR) AS req, count(*) AS total FROM fx_eod GROUP BY 1
UNION ALL SELECT exchange AS req, count(*) AS total FROM fx_eod GROUP BY 1"""}, """
SELECT req, total, CAST(o // 1000 AS INT) AS page_no, CAST(o AS BIGINT) AS page_offset,
       CAST(CASE WHEN total <= 1000 THEN total ELSE 1000 END AS BIGINT) AS page_limit
FROM (SELECT req, total, unnest(range(0, greatest(total, 1), 1000)) AS o FROM t)"""),
    "flatten_exchanges": _with(_fx("fx_exchange"), "SELECT " + ", ".join(TABLES["DimExchange"][3]) + " FROM fx_exchange"),
    "flatten_eod": _with(_fx("fx_eod"), "SELECT " + _dbl(EOD_COLS, EOD_FLOATS) + " FROM fx_eod"),
    "flatten_bad_dates": _with(_fx("fx_eod_bad"), "SELECT " + _dbl(EOD_COLS, EOD_FLOATS) + " FROM fx_eod_bad"),
    "flatten_intraday": _with(_fx("fx_intraday"), "SELECT " + _dbl(
        ["open", "high", "low", "last", "close", "volume", "date", "symbol", "exchange"],
        {"open", "high", "low", "last", "close", "volume"}) + " FROM fx_intraday"),
    "flatten_dividends": _with(_fx("fx_dividends"),
                               "SELECT date, CAST(dividend AS DOUBLE) AS dividend, symbol, pk FROM fx_dividends"),
    "flatten_splits": _with(_fx("fx_splits"),
                            "SELECT date, CAST(split_factor AS DOUBLE) AS split_factor, symbol, pk FROM fx_splits"),
    "flatten_companies": _with(_fx("fx_company"), "SELECT " + ", ".join(TABLES["DimCompany"][3]) + " FROM fx_company"),
    "flatten_currencies": _with(_fx("fx_currency"), "SELECT code, symbol, name FROM fx_currency"),
    "flatten_timezones": _with(_fx("fx_timezone"), "SELECT timezone, abbr, abbr_dst FROM fx_timezone"),
    "calendar_csv": FX["fx_calendar"],
    "landing_roundtrip": _with(_fx("fx_eod"), "SELECT " + _dbl(EOD_COLS, EOD_FLOATS) + ", dayId, runId FROM fx_eod"),
    "landing_append_two_runs": _with(_fx("fx_dividends"),
                                     "SELECT date, CAST(dividend AS DOUBLE) AS dividend, symbol, pk, dayId, runId "
                                     "FROM fx_dividends"),
    "landing_run_counts": _with(_fx("fx_eod"), _eod_landing_runs()),
    "land_endpoint": _with(_fx("fx_eod"), "SELECT " + _dbl(EOD_COLS, EOD_FLOATS) + ", dayId, runId FROM fx_eod" + "".join(
        " UNION ALL SELECT " + _dbl(EOD_COLS, EOD_FLOATS) + ", 20220703 AS dayId, "
        f"CAST((SELECT max(runId) FROM fx_eod WHERE dayId = 20220703) + {i} AS INT) AS runId FROM fx_eod" for i in (1, 2))),
    "table_location": _landed_counts(),
    "stream_land_eod": _with(_fx("fx_eod"), "SELECT " + _dbl(EOD_COLS, EOD_FLOATS) + " FROM fx_eod"),
    "partition_listing": _with(_fx("fx_eod"), "SELECT DISTINCT dayId, runId FROM fx_eod"),
    "max_day_run": _with(_fx("fx_eod"), "SELECT * FROM " + _latest("fx_eod")),
    "latest_run_rows": _with(_fx("fx_eod"), "SELECT " + _dbl(EOD_COLS, EOD_FLOATS) +
                             ", dayId, runId FROM fx_eod WHERE dayId = (SELECT dayId FROM " + _latest("fx_eod") +
                             ") AND runId = (SELECT runId FROM " + _latest("fx_eod") + ")"),
    "next_run_id": _with(_fx("fx_eod"), """
SELECT p.dayId, CAST(coalesce(max(f.runId) + 1, 1) AS INT) AS next_run_id
FROM (SELECT DISTINCT dayId FROM fx_eod UNION SELECT max(dayId) + 1 FROM fx_eod) p
LEFT JOIN fx_eod f ON f.dayId = p.dayId GROUP BY p.dayId"""),
    "distinct_company": _distinct("DimCompany", "symbol", drop_pk=True),
    "distinct_currency": _distinct("DimCurrency", "code"),
    "distinct_exchange": _distinct("DimExchange", "mic"),
    "distinct_dividends": _distinct("FactDividends", "pk"),
    "distinct_eod": _distinct("FactEod", "pk"),
    "distinct_splits": _distinct("FactSplits", "pk"),
    "distinct_eod_latest": _distinct("FactEod", "pk", "latest"),
    "merge_incremental_eod": _merge("FactEod"),
    "merge_incremental_dividends": _merge("FactDividends"),
    "merge_incremental_splits": _merge("FactSplits"),
    "merge_incremental_company": _merge("DimCompany"),
    "merge_incremental_exchange": _merge("DimExchange"),
    "merge_incremental_currency": _merge("DimCurrency"),
    "merge_full_eod": _merge("FactEod", full=True),
    "merge_full_dividends": _merge("FactDividends", full=True),
    "merge_full_splits": _merge("FactSplits", full=True),
    "merge_full_company": _merge("DimCompany", full=True),
    "merge_full_exchange": _merge("DimExchange", full=True),
    "merge_full_currency": _merge("DimCurrency", full=True),
    "merge_calendar": FX["fx_calendar"],
    "merge_unmapped_columns": _merge("FactEod", unmapped="Dividend"),
    "merge_null_keys": _merge("FactEod", bad=True),
    "staging_recreated": "SELECT m.PK, m.Symbol, m.Dividend, m.Date, n.n_landed FROM (" + _merge("FactDividends") + ") m JOIN ("
        + _with(_fx("fx_dividends"), "SELECT pk, count(*) AS n_landed FROM fx_dividends GROUP BY pk") + ") n ON m.PK = n.pk "
        "UNION ALL SELECT CurrencyId, Symbol, NULL, NULL, NULL FROM (" + _merge("DimCurrency") + ")",
    "fact_marks": "SELECT Symbol, count(*) AS n_rows, max(Date) AS max_date FROM (" + _merge("FactEod") + ") GROUP BY Symbol",
    "staging_partition_overwrite": "SELECT Date, count(*) AS n_rows FROM (" + _merge("FactEod") + ") GROUP BY Date",
    "vw_dim_company": _view({**_staged("DimCompany"), **_staged("DimExchange")}, """
SELECT CompanyId, CompanyName, ExchangeId, Country FROM (
  SELECT c.CompanyId, c.CompanyName, c.ExchangeId, e.Country,
         row_number() OVER (PARTITION BY c.CompanyId ORDER BY c.ExchangeId DESC) AS rownum
  FROM stg_DimCompany c JOIN stg_DimExchange e ON c.ExchangeId = e.ExchangeId)
WHERE rownum = 1 AND CompanyName IS NOT NULL"""),
    "vw_dim_company_exchange": _view(_staged("DimCompany"), """
SELECT PK AS CompanyExchangeId, CompanyId, CompanyName, ExchangeId FROM stg_DimCompany
WHERE CompanyName IS NOT NULL"""),
    "vw_dim_currency": _view(_staged("DimCurrency"), "SELECT CurrencyId, Symbol, Name FROM stg_DimCurrency"),
    "vw_dim_date": _view(_calendar(), "SELECT *, YearId || ' Q' || Quarter AS YearAndQuarter FROM stg_DimDate"),
    "vw_dim_exchange": _view(_staged("DimExchange"), """
SELECT ExchangeId, Name, Acronym, Country, CountryCode, City, Website, TimezoneName, TimezoneCode,
       CurrencyId FROM stg_DimExchange"""),
    "vw_fact_dividends": _view(_staged("FactDividends"), "SELECT Symbol, Dividend, Date FROM stg_FactDividends"),
    "vw_fact_eod": _view(_staged("FactEod"), """
SELECT Symbol || '_' || ExchangeId AS CompanyExchangeId, Symbol AS CompanyId, Open, High, Low, Close,
       Volume, SplitFactor, Dividend, ExchangeId, Date,
       Close / NULLIF(Open, 0) - 1 AS OpenToCloseChange,
       High / NULLIF(Low, 0) - 1 AS LowToHightChange
FROM stg_FactEod"""),
    "vw_fact_splits": _view(_staged("FactSplits"), "SELECT Symbol, SplitFactor, Date FROM stg_FactSplits"),
    "companies_per_exchange": _view(_staged("DimCompany"),
                                    "SELECT CompanyId FROM stg_DimCompany WHERE ExchangeId IN ('X3')"),
    "companies_per_exchange_multi": _view(_staged("DimCompany"),
                                          "SELECT CompanyId FROM stg_DimCompany WHERE ExchangeId IN ('X1', 'X2', 'X3')"),
    "fact_symbols_distinct": _view(_staged("FactEod"), "SELECT DISTINCT Symbol FROM stg_FactEod"),
    "fact_symbols_for_exchange": _view({**_staged("DimCompany"), **_staged("FactEod")}, """
SELECT DISTINCT Symbol FROM stg_FactEod
WHERE Symbol IN (SELECT CompanyId FROM stg_DimCompany WHERE ExchangeId IN ('X3'))"""),
    "missing_companies": _with(_hwm_ctes(), """
SELECT DISTINCT group_id, CompanyId FROM comp
WHERE CompanyId NOT IN (SELECT DISTINCT Symbol FROM stg_FactEod)"""),
    "max_date_per_symbol": _with(_hwm_ctes(), "SELECT Symbol, max_date FROM symmax"),
    "high_water_mark": _with(_hwm_ctes(), "SELECT group_id, date_from FROM hwm"),
    "int_to_date": _view(_staged("FactEod"), """
SELECT Date, strftime(strptime(CAST(Date AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS date_text
FROM (SELECT DISTINCT Date FROM stg_FactEod)"""),
    "symbol_chunks": _with(_hwm_ctes(), "SELECT group_id, chunk_no, n_symbols, symbols FROM chunks"),
    "fact_request_paths": _with(_hwm_ctes(), """
SELECT c.group_id, c.chunk_no, c.symbols, h.date_from, '2022-07-03' AS date_to,
       'eod?symbols=' || c.symbols || '&date_from=' || h.date_from || '&date_to=2022-07-03' AS path
FROM chunks c JOIN hwm h ON c.group_id = h.group_id"""),
    "dim_request_paths": _view(_staged("DimExchange"), """
SELECT 'DimExchange' AS table_name, CAST(NULL AS VARCHAR) AS exchange, 'exchanges' AS path
UNION ALL SELECT 'DimCurrency', NULL, 'currencies'
UNION ALL SELECT 'DimCompany', ExchangeId, 'tickers?exchange=' || ExchangeId FROM stg_DimExchange"""),
    "load_dim": _with(_staged("DimCompany"), "SELECT * FROM stg_DimCompany"),
    "load_fact": _with(_load_eod(), "SELECT * FROM loaded_eod"),
    "batch_outcomes": _with({**_staged("DimExchange"), **_staged("DimCompany")}, """
SELECT 'DimExchange' AS table_name, '' AS scope, 'loaded' AS status, 1 AS run_id, NULL AS error,
       (SELECT count(*) FROM stg_DimExchange) AS n_rows
UNION ALL SELECT 'DimCurrency', '', 'failed', NULL, 'rate_limit_reached', 0
UNION ALL SELECT 'DimCompany', exchangeMic, 'loaded', 1, NULL, (SELECT count(*) FROM stg_DimCompany)
FROM (SELECT DISTINCT exchangeMic FROM fx_company)"""),
    "update_tables": _with({**_load_eod(), **_staged("DimExchange"), **_staged("DimCurrency")}, " UNION ALL ".join([
        _content("DimExchange", ["ExchangeId", "Name", "Country", "CurrencyId"]) + "stg_DimExchange",
        _content("DimCurrency", ["CurrencyId", "Symbol", "Name"]) + "stg_DimCurrency",
        _content("DimCompany", ["PK", "CompanyId", "CompanyName", "ExchangeId"]) + "stg_DimCompany",
        _content("FactEod", ["PK", "Symbol", "ExchangeId", "Date"]) + "loaded_eod",
        "SELECT 'FactEod runs' AS table_name, unnest(['20220703|1', '20220703|2']) AS content"])),
    "merge_mapping_without_partition": _merge_without_date(),
    "merge_key_without_date": _merge_by_symbol(),
    "reload_matches_incremental": _with(_staged("FactDividends"),
                                        "SELECT *, CAST(1 AS BIGINT) AS n_before, CAST(1 AS BIGINT) AS n_after FROM stg_FactDividends"),
}
