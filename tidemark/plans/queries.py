"""Registered queries: each operator of the inventory run over whole tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame. Inputs are
the endpoint records derived from the driver's tables (``tidemark.fixtures``);
queries that land or merge write real tables under the session's shared
checkpoint folder first and return a read of what was written.

FLOAT columns are widened to DOUBLE on output (exactly; no value changes) so
results compare bit-for-bit with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemark import fixtures as fx
from tidemark.operators import incremental as inc
from tidemark.operators.dedupe import dedupe_runs
from tidemark.operators.flatten import flatten, flatten_eod
from tidemark.operators.paging import page_requests as plan_pages
from tidemark.operators.runs import max_day_run, next_run_ids, run_row_counts
from tidemark.plans import loader as LD
from tidemark.plans import requests as RQ
from tidemark.plans import views as V
from tidemark.schemas import COLUMN_MAPPING, LANDING_KEY, STAGING_KEY
from tidemark.session import delete_path, shared_dir
from tidemark.sinks import landing as L
from tidemark.sinks import staging as S
from tidemark.sources import calendar as CAL
from tidemark.sources import pages as P

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered scenario.
ONE_EXCHANGE = ["X3"]
SOME_EXCHANGES = ["X1", "X2", "X3"]
ALL_GROUP = "ALL"


def widen(df: DataFrame) -> DataFrame:
    """FLOAT -> DOUBLE for comparison (exact)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, FloatType)
                       else F.col(f.name) for f in df.schema.fields])


# --------------------------------------------------------------------------- inputs

def through_pages(spark: SparkSession, sf_dir: str, endpoint: str, bad_dates: bool = False) -> DataFrame:
    """Records -> API pages (JSON text) -> parsed and exploded records."""
    rows = fx.fx_eod(spark, sf_dir, bad_dates=True) if bad_dates else fx.FIXTURE_OF_ENDPOINT[endpoint](spark, sf_dir)
    pages = P.build_pages(rows, fx.record_struct(rows, endpoint))
    return P.explode_pages(P.parse_pages(pages, endpoint))


def landing_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Every landed row of a table (with ties), i.e. the landing table's content."""
    if table == "FactEod":
        return fx.fx_eod(spark, sf_dir)
    if table == "FactDividends":
        return fx.fx_dividends(spark, sf_dir)
    if table == "FactSplits":
        return fx.fx_splits(spark, sf_dir)
    if table == "DimCompany":
        return fx.fx_company(spark, sf_dir)
    if table == "DimExchange":   # the flattener drops exchanges without a mic
        return fx.fx_exchange(spark, sf_dir).where(F.col("mic").isNotNull())
    if table == "DimCurrency":
        return fx.fx_currency(spark, sf_dir)
    raise ValueError(table)


TABLES = ["FactEod", "FactDividends", "FactSplits", "DimCompany", "DimExchange", "DimCurrency"]

_PREPARED: dict = {}


def _prepared(spark: SparkSession, sf_dir: str, kind: str, table: str, make):
    """What ``make`` returns, made once per session for (sf_dir, kind, table)."""
    key = (spark.sparkContext.applicationId, sf_dir, kind, table)
    if key not in _PREPARED:
        _PREPARED[key] = make()
    return _PREPARED[key]


def _new_lake(spark: SparkSession) -> LD.Lake:
    root = shared_dir(spark, "lake")
    tag = root.rsplit("/", 1)[1][:10]
    return LD.Lake(spark, root, f"landing_{tag}", f"staging_{tag}", f"analytics_{tag}")


def lake_of(spark: SparkSession, sf_dir: str) -> LD.Lake:
    """The lake of the session's prepared tables."""
    return _prepared(spark, sf_dir, "lake", "", lambda: _new_lake(spark))


def _land(spark: SparkSession, lt: L.LandingTable, rows: DataFrame) -> None:
    """Append runs of the latest day and later ones."""
    L.append_runs(rows, lt)
    L.discover(spark, lt)


def landed(spark: SparkSession, sf_dir: str, table: str) -> L.LandingTable:
    """The table's fixture runs as a landing table, in two appends: the latest run comes last."""
    staged_table(spark, sf_dir, table)
    return lake_of(spark, sf_dir).landing(table)


def staged_table(spark: SparkSession, sf_dir: str, table: str) -> LD.Lake:
    """A lake whose staging ``table`` has had two merges: a full reload, then the latest run."""
    lake = lake_of(spark, sf_dir)

    def make():
        if table == "DimDate":
            two_calendar_merges(spark, sf_dir, lake)
        else:
            two_merges(spark, sf_dir, table, lake)
        lake.create_views()
        return True

    _prepared(spark, sf_dir, "staged", table, make)
    return lake


def staged(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Current staging content of the prepared table."""
    return staged_table(spark, sf_dir, table).read_staging(table)


def marks(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The marks that the prepared table's merges kept."""
    return staged_table(spark, sf_dir, table).read_marks(table)


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Make the landing and staging tables, and the page files, that the queries share."""
    for table in [*TABLES, "DimDate"]:
        staged_table(spark, sf_dir, table)
    first_answers(spark, sf_dir)


def split_latest(spark: SparkSession, sf_dir: str, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows outside the latest run, rows of the latest run)."""
    rows = landing_rows(spark, sf_dir, table)
    latest = max_day_run(rows.select("dayId", "runId")).first()
    in_latest = (F.col("dayId") == latest.dayId) & (F.col("runId") == latest.runId)
    return rows.where(~in_latest), rows.where(in_latest)


def two_merges(spark: SparkSession, sf_dir: str, table: str, lake: LD.Lake, second: dict | None = None,
               first: dict | None = None, recency: str = "latest", latest_rows: DataFrame | None = None) -> LD.Lake:
    """Land all runs but the latest and reload staging from them; land the latest run and merge as ``second`` says."""
    rest, latest = split_latest(spark, sf_dir, table)
    lt = lake.landing(table)
    _land(spark, lt, rest)
    LD.merge_landed(spark, lake, table, {"is_full_reload": True, **(first or {})})
    _land(spark, lt, latest if latest_rows is None else latest_rows)
    LD.merge_landed(spark, lake, table, second or {}, recency)
    return lake


def two_calendar_merges(spark: SparkSession, sf_dir: str, lake: LD.Lake) -> LD.Lake:
    """The calendar, read from CSV, merged over one that lacks its last year and one that is whole."""
    cal = CAL.calendar_rows(fx.calendar_span(spark, sf_dir))
    path = shared_dir(spark, "calendar")
    CAL.write_calendar_csv(cal, path)
    last_year = cal.agg(F.max("YearId")).first()[0]
    for rows in (cal.where(F.col("YearId") < last_year), CAL.read_calendar_csv(spark, path)):
        S.merge_into(spark, lake.staging("DimDate"), rows, ["DateNum"], COLUMN_MAPPING["DimDate"])
    return lake


def bad_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest eod run with junk dates on some records, flattened: NULL dates and keys."""
    rows = landing_rows(spark, sf_dir, "FactEod")
    latest = max_day_run(rows.select("dayId", "runId")).first()
    raw = fx.fx_eod(spark, sf_dir, bad_dates=True).where(
        (F.col("dayId") == latest.dayId) & (F.col("runId") == latest.runId))
    records = raw.select(fx.record_struct(raw, "eod").alias("r"), "dayId", "runId").select("r.*", "dayId", "runId")
    return flatten_eod(records, keep=["dayId", "runId"])


def groups_each_exchange(dim_company: DataFrame) -> DataFrame:
    """Every exchange as its own request group, plus one group of all of them."""
    ex = dim_company.select("ExchangeId").distinct()
    return ex.select(F.col("ExchangeId").alias("group_id"), "ExchangeId") \
        .unionByName(ex.select(F.lit(ALL_GROUP).alias("group_id"), "ExchangeId"))


# --------------------------------------------------------------------------- queries

def q_page_explode(spark, sf_dir):
    rows = fx.fx_eod(spark, sf_dir)
    path = shared_dir(spark, "pages", "eod")
    P.write_pages(P.build_pages(rows, fx.record_struct(rows, "eod")), path)
    return widen(P.explode_pages(P.read_pages(spark, path, "eod")))


BAD_PAGE = '{"error": {"code": "rate_limit_reached"}}'


def q_page_quarantine(spark, sf_dir):
    """Eod pages of which every third is an error, landed with a quarantine: landed keys, and what was set aside."""
    rows = fx.fx_eod(spark, sf_dir)
    pages = P.build_pages(rows, fx.record_struct(rows, "eod"), order=fx.EOD_TIES)
    answered = pages.select(F.concat(F.lit("eod?page="), F.col("page_no").cast("string")).alias("request"), F.lit(0).cast("long").alias("offset"),
                            F.when(F.col("page_no") % 3 == 1, F.lit(BAD_PAGE)).otherwise(F.col("page")).alias("page"))
    lt, kept = _new_lake(spark).landing("FactEod"), shared_dir(spark, "quarantine")
    LD.land_pages(spark, lt, answered, "eod", LD.run_day(fx.NOW), quarantine=kept)
    landed_ = L.read_landing(spark, lt).select(F.lit("landed").alias("side"), F.col("pk").alias("name"), F.lit(None).cast("string").alias("page"),
                                               "dayId", "runId")
    bad = spark.read.schema(f"{P.FETCHED}, dayId INT, runId INT").json(kept)
    return landed_.unionByName(bad.select(F.lit("quarantined").alias("side"), F.col("request").alias("name"), "page", "dayId", "runId"))


def q_page_totals(spark, sf_dir):
    rows = fx.fx_eod(spark, sf_dir)
    pages = P.build_pages(rows, fx.record_struct(rows, "eod"), order=fx.EOD_TIES)
    parsed = P.parse_pages(pages.select("page_no", "page"), "eod")
    return P.page_totals(parsed, "page_no")


def q_page_requests(spark, sf_dir):
    eod = fx.fx_eod(spark, sf_dir)
    totals = (eod.groupBy(F.concat("exchange", F.lit("_"), F.col("date").cast("string")).alias("req"))
              .agg(F.count(F.lit(1)).alias("total"))
              .unionByName(eod.groupBy(F.col("exchange").alias("req")).agg(F.count(F.lit(1)).alias("total"))))
    return plan_pages(totals).select("req", "total", "page_no", F.col("offset").alias("page_offset"),
                                     F.col("limit").alias("page_limit"))


def _flatten_q(endpoint, bad_dates=False):
    def q(spark, sf_dir):
        return widen(flatten(through_pages(spark, sf_dir, endpoint, bad_dates), endpoint))
    return q


def q_calendar_csv(spark, sf_dir):
    path = shared_dir(spark, "calendar")
    CAL.write_calendar_csv(CAL.calendar_rows(fx.calendar_span(spark, sf_dir)), path)
    return CAL.read_calendar_csv(spark, path)


def q_landing_roundtrip(spark, sf_dir):
    return widen(L.read_landing(spark, landed(spark, sf_dir, "FactEod")))


def q_landing_append_two_runs(spark, sf_dir):
    rows = landing_rows(spark, sf_dir, "FactDividends")
    lt = _new_lake(spark).landing("FactDividends")
    for later in (False, True):
        L.append_runs(rows.where((F.col("runId") > 6) == F.lit(later)), lt)
        L.repair(spark, lt)  # the later runs lie under earlier days too
    return widen(L.read_landing(spark, lt))


def q_table_location(spark, sf_dir):
    """Each prepared table's location (C6), from its parts on, and the rows found there."""
    lake, out = lake_of(spark, sf_dir), []
    for t in TABLES:
        staged_table(spark, sf_dir, t)
        at = L.table_location(spark, lake.landing(t).name)
        out.append(spark.read.parquet(at).select(F.lit(t).alias("table_name"),
                                                 F.lit("/".join(at.rstrip("/").split("/")[-2:])).alias("location")))
    union = out[0]
    for df in out[1:]:
        union = union.unionByName(df)
    return union.groupBy("table_name", "location").agg(F.count(F.lit(1)).alias("n_rows"))


def q_landing_run_counts(spark, sf_dir):
    return run_row_counts(L.read_landing(spark, landed(spark, sf_dir, "FactEod")))


def q_land_endpoint(spark, sf_dir):
    """Two more runs of the whole eod response on the fixed run day, as landed."""
    rows = landing_rows(spark, sf_dir, "FactEod")
    lt = _new_lake(spark).landing("FactEod")
    _land(spark, lt, rows)
    pages_path = shared_dir(spark, "pages", "eod")
    P.write_pages(P.build_pages(rows, fx.record_struct(rows, "eod")), pages_path)
    for _ in range(2):
        LD.land_pages(spark, lt, P.read_pages(spark, pages_path, "eod").select("page"), "eod", LD.run_day(fx.NOW))
    delete_path(spark, pages_path)  # both runs hold its records
    return widen(L.read_landing(spark, lt))


def q_stream_land_eod(spark, sf_dir):
    """Eod pages dropped into an inbox, landed by a file stream, read back."""
    from tidemark.streaming import stream_pages_to_landing
    rows = landing_rows(spark, sf_dir, "FactEod")
    inbox = shared_dir(spark, "inbox", "eod")
    P.write_pages(P.build_pages(rows, fx.record_struct(rows, "eod")), inbox)
    lt = _new_lake(spark).landing("FactEod")
    query = stream_pages_to_landing(spark, inbox, "eod", lt, LD.run_day(fx.NOW),
                                    shared_dir(spark, "stream-checkpoint"), max_files_per_trigger=4)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return widen(L.read_landing(spark, lt).drop("dayId", "runId"))


def q_partition_listing(spark, sf_dir):
    return L.partitions(spark, landed(spark, sf_dir, "FactEod"))


def q_max_day_run(spark, sf_dir):
    return max_day_run(L.partitions(spark, landed(spark, sf_dir, "FactEod")))


def q_latest_run_rows(spark, sf_dir):
    return widen(L.latest_run_rows(spark, landed(spark, sf_dir, "FactEod")))


def q_next_run_id(spark, sf_dir):
    parts = L.partitions(spark, landed(spark, sf_dir, "FactEod"))
    probes = parts.select("dayId").unionByName(parts.agg((F.max("dayId") + 1).alias("dayId")))
    return next_run_ids(parts, probes)


def _distinct_q(table):
    def q(spark, sf_dir):
        return widen(spark.table(V.distinct_view(landed(spark, sf_dir, table).database, table)))
    return q


def q_distinct_eod_latest(spark, sf_dir):
    return widen(LD.merge_source(spark, landed(spark, sf_dir, "FactEod"), full_reload=True))


def _merge_q(table, full=False, mapping=None, bad_dates=False):
    """Two merges of a fresh lake: a reload of all runs but the latest, then the latest or (as written) all runs."""
    def q(spark, sf_dir):
        second = {"is_full_reload": full, "column_mapping": mapping}
        bad = bad_latest_run(spark, sf_dir) if bad_dates else None
        lake = two_merges(spark, sf_dir, table, _new_lake(spark), second, recency="reference" if full else "latest", latest_rows=bad)
        return widen(lake.read_staging(table))
    return q


def q_reload_matches_incremental(spark, sf_dir):
    """After an incremental merge a full reload changes nothing: the reloaded table, with both sides' rows counted."""
    lake = two_merges(spark, sf_dir, "FactDividends", _new_lake(spark))
    before = lake.read_staging("FactDividends").withColumn("n_before", F.lit(1))
    LD.merge_landed(spark, lake, "FactDividends", {"is_full_reload": True})
    after = lake.read_staging("FactDividends").withColumn("n_after", F.lit(1))
    both = before.unionByName(after, allowMissingColumns=True)
    return widen(both.groupBy("PK", "Symbol", "Dividend", "Date").agg(
        F.count("n_before").alias("n_before"), F.count("n_after").alias("n_after")))


def q_merge_key_without_date(spark, sf_dir):
    """Splits keyed by symbol: a matched row moves to its update's date and leaves its old one."""
    mapping = {**COLUMN_MAPPING["FactSplits"], "PK": "symbol"}
    rest, latest = split_latest(spark, sf_dir, "FactSplits")
    ties = V.tie_columns("FactSplits", "symbol")
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "staging", "FactSplits"))
    for rows in (rest, latest):
        S.merge_into(spark, st, dedupe_runs(rows, "symbol", "latest", ties), ["PK"], mapping)
    return widen(S.read_staging(spark, st))


def q_merge_calendar(spark, sf_dir):
    return two_calendar_merges(spark, sf_dir, _new_lake(spark)).read_staging("DimDate")


def q_staging_recreated(spark, sf_dir):
    """Landing and staging of two tables, brought back from storage after the catalog lost them: their contents."""
    lake = _new_lake(spark)
    for table in ("FactDividends", "DimCurrency"):
        two_merges(spark, sf_dir, table, lake)
    for database in (lake.landing_db, lake.staging_db):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    found = LD.Lake(spark, lake.root, lake.landing_db, lake.staging_db, lake.analytics_db)
    found.recreate()
    landed_ = L.read_landing(spark, found.landing("FactDividends")).groupBy(F.col("pk").alias("PK")).agg(F.count(F.lit(1)).alias("n_landed"))
    fact = found.read_staging("FactDividends").join(landed_, "PK", "left")
    dim = found.read_staging("DimCurrency").select(F.col("CurrencyId").alias("PK"), "Symbol", F.lit(None).cast("float").alias("Dividend"),
                                                   F.lit(None).cast("int").alias("Date"), F.lit(None).cast("long").alias("n_landed"))
    return widen(fact.select("PK", "Symbol", "Dividend", "Date", "n_landed").unionByName(dim))


def q_fact_marks(spark, sf_dir):
    """What two merges keep of a fact table: rows and latest date of each symbol."""
    return marks(spark, sf_dir, "FactEod")


def q_staging_partition_overwrite(spark, sf_dir):
    out = two_merges(spark, sf_dir, "FactEod", _new_lake(spark)).read_staging("FactEod")
    return out.groupBy("Date").agg(F.count(F.lit(1)).alias("n_rows"))


def _view_q(view):
    def q(spark, sf_dir):
        for t in V.ANALYTICS[view][0]:
            lake = staged_table(spark, sf_dir, t)
        lake.create_views()
        return widen(spark.table(f"{lake.analytics_db}.{view}"))
    return q


def q_companies_per_exchange(spark, sf_dir, exchanges=ONE_EXCHANGE):
    ex = spark.createDataFrame([(x,) for x in exchanges], "ExchangeId STRING")
    return inc.companies_in(staged(spark, sf_dir, "DimCompany"), ex)


def q_companies_per_exchange_multi(spark, sf_dir):
    return q_companies_per_exchange(spark, sf_dir, SOME_EXCHANGES)


def q_fact_symbols_distinct(spark, sf_dir):
    return inc.fact_symbols(staged(spark, sf_dir, "FactEod"))


def q_fact_symbols_for_exchange(spark, sf_dir):
    ex = spark.createDataFrame([(x,) for x in ONE_EXCHANGE], "ExchangeId STRING")
    companies = inc.companies_in(staged(spark, sf_dir, "DimCompany"), ex)
    return inc.fact_symbols_for(staged(spark, sf_dir, "FactEod"), companies)


def q_missing_companies(spark, sf_dir):
    dim = staged(spark, sf_dir, "DimCompany")
    companies = inc.companies_per_group(dim, groups_each_exchange(dim))
    return inc.missing_companies(companies, marks(spark, sf_dir, "FactEod"))


def q_max_date_per_symbol(spark, sf_dir):
    return inc.max_date_per_symbol(staged(spark, sf_dir, "FactEod"))


def q_high_water_mark(spark, sf_dir):
    dim = staged(spark, sf_dir, "DimCompany")
    return inc.high_water_marks_from(groups_each_exchange(dim), dim, marks(spark, sf_dir, "FactEod"), fx.HISTORY_START)


def q_int_to_date(spark, sf_dir):
    from tidemark.functions import int_to_date
    return staged(spark, sf_dir, "FactEod").select("Date").distinct() \
        .select("Date", int_to_date("Date").alias("date_text"))


def q_symbol_chunks(spark, sf_dir):
    dim = staged(spark, sf_dir, "DimCompany")
    return RQ.symbol_chunks(inc.companies_per_group(dim, groups_each_exchange(dim)))


def q_fact_request_paths(spark, sf_dir):
    dim = staged(spark, sf_dir, "DimCompany")
    return RQ.fact_requests(groups_each_exchange(dim), dim, marks(spark, sf_dir, "FactEod"),
                            "eod", fx.HISTORY_START, fx.NOW)


def q_dim_request_paths(spark, sf_dir):
    return RQ.dim_requests(spark, ["DimExchange", "DimCurrency", "DimCompany"],
                           staged(spark, sf_dir, "DimExchange").select("ExchangeId"))


# ------------------------------------------------------------------ config-driven loads

def all_exchanges(spark, sf_dir) -> list[str]:
    """The exchanges that companies are listed on, as a config would name them (one per nation)."""
    rows = fx.fx_company(spark, sf_dir).select("exchangeMic").distinct().orderBy("exchangeMic").collect()
    return [r[0] for r in rows]


def dim_config(exchanges) -> dict:
    tables = [{"is_enabled": True, "is_full_reload": False, "table_name": t, "exchange": "",
               "merge_keys": f"destination.{STAGING_KEY[t]} = updates.{LANDING_KEY[t]}",
               "column_mapping": {k: f"updates.{v}" for k, v in COLUMN_MAPPING[t].items()}}
              for t in ("DimExchange", "DimCurrency")]
    for x in exchanges:
        tables.append({"is_enabled": True, "is_full_reload": False, "table_name": "DimCompany",
                       "exchange": x, "merge_keys": "destination.PK = updates.pk",
                       "column_mapping": {k: f"updates.{v}" for k, v in COLUMN_MAPPING["DimCompany"].items()}})
    tables.append({"is_enabled": False, "table_name": "DimCompany", "exchange": "X9"})
    return {"general": {"landing_database_name": "landing", "staging_database_name": "staging"},
            "table_type": "Dim", "tables": tables}


def fact_config(exchanges, full_reload=False) -> dict:
    return {"general": {"landing_database_name": "landing", "staging_database_name": "staging"},
            "table_type": "Fact",
            "tables": [{"is_enabled": True, "is_full_reload": full_reload, "endpoint_name": "eod",
                        "history_start_date": fx.HISTORY_START, "table_name": "FactEod",
                        "exchanges": ", ".join(f"'{x}'" for x in exchanges), "merge_keys": "destination.PK = updates.pk",
                        "column_mapping": {k: f"updates.{v}" for k, v in COLUMN_MAPPING["FactEod"].items()}}]}


def answer_dims(spark, sf_dir, source, exchanges) -> None:
    """Land the pages of the dimensions' requests."""
    listed = spark.createDataFrame([(x,) for x in exchanges], "ExchangeId STRING")
    for t, endpoint in (("DimExchange", "exchanges"), ("DimCurrency", "currencies"), ("DimCompany", "tickers")):
        requests = RQ.dim_requests(spark, [t], listed if t == "DimCompany" else None)
        fx.land_answers(spark, sf_dir, t, endpoint, requests, source.root)


def load_dims(spark, sf_dir) -> tuple[LD.Lake, LD.FilePageSource, list[str]]:
    """A fresh lake with its dimensions loaded from page files that were landed before."""
    lake, exchanges = _new_lake(spark), all_exchanges(spark, sf_dir)
    source = LD.FilePageSource(spark, shared_dir(spark, "inbox"))
    answer_dims(spark, sf_dir, source, exchanges)
    LD.update_tables(spark, dim_config(exchanges), source, lake, fx.NOW)
    return lake, source, exchanges


def load_facts(spark, sf_dir, lake, source, exchanges, fetched_at: int) -> None:
    """Land the pages of the next planned requests, then load them."""
    config = fact_config(exchanges)
    requests = LD.plan_fact(spark, lake, config["tables"][0], fx.NOW)
    fx.land_answers(spark, sf_dir, "FactEod", "eod", requests, source.root, fetched_at)
    LD.update_tables(spark, config, source, lake, fx.NOW)


#: Fetches of other requests that lie in the prepared page store.
OLDER_FETCHES = 100


def first_answers(spark, sf_dir) -> tuple[LD.FilePageSource, list[str]]:
    """A page store that answers the first load of every table, among older fetches; made once per session."""
    def make():
        lake, source, exchanges = load_dims(spark, sf_dir)
        requests = LD.plan_fact(spark, lake, fact_config(exchanges)["tables"][0], fx.NOW)
        fx.land_answers(spark, sf_dir, "FactEod", "eod", requests, source.root, OLDER_FETCHES + 1)
        symbols = fx.fx_eod(spark, sf_dir).select("symbol").distinct().checkpoint(eager=True)  # read for the pages and their index
        old = symbols.select(F.concat(F.lit("eod?symbols="), "symbol").alias("request")).distinct().select(
            "request", F.lit(0).cast("long").alias("offset"), F.lit('{"pagination": {"total": 0}, "data": []}').alias("page"))
        turn = (F.pmod(F.xxhash64("request"), F.lit(OLDER_FETCHES)) + 1).cast("long")
        P.land_fetches(old.withColumn("fetched_at", turn), f"{source.root}/FactEod")
        return source, exchanges

    return _prepared(spark, sf_dir, "answers", "", make)


def q_load_dim(spark, sf_dir):
    source, exchanges = first_answers(spark, sf_dir)
    lake = _new_lake(spark)
    LD.update_tables(spark, dim_config(exchanges), source, lake, fx.NOW)
    return lake.read_staging("DimCompany")


def q_load_fact(spark, sf_dir):
    """Dimensions, then facts, loaded into a fresh lake from a page store that holds many older fetches too."""
    source, exchanges = first_answers(spark, sf_dir)
    lake = _new_lake(spark)
    for config in (dim_config(exchanges), fact_config(exchanges)):
        LD.update_tables(spark, config, source, lake, fx.NOW)
    return widen(lake.read_staging("FactEod"))


def q_batch_outcomes(spark, sf_dir):
    """A batch of dimensions of which the currencies' page is an error: what each load came to, and what the tables hold."""
    lake, exchanges = _new_lake(spark), all_exchanges(spark, sf_dir)
    source = LD.FilePageSource(spark, shared_dir(spark, "inbox"))
    answer_dims(spark, sf_dir, source, exchanges)
    P.land_fetched(spark.createDataFrame([("currencies", 0, BAD_PAGE)], P.FETCHED), f"{source.root}/DimCurrency", 2)
    outcomes = LD.outcome_table(spark, LD.load_batch(spark, dim_config(exchanges), source, lake, fx.NOW))
    held = None
    for t in ("DimExchange", "DimCurrency", "DimCompany"):
        rows = lake.read_staging(t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        held = rows if held is None else held.unionByName(rows)
    return outcomes.join(held, "table_name").select("table_name", "scope", "status", "run_id", F.regexp_extract("error", "rate_limit_[a-z]+", 0).alias("error"),
                                                    "n_rows")


def q_update_tables(spark, sf_dir):
    """Dims, then two fact runs (the second starts at the high-water mark): every table's rows, as JSON."""
    lake, source, exchanges = load_dims(spark, sf_dir)
    for fetch in (1, 2):
        load_facts(spark, sf_dir, lake, source, exchanges, fetch)
    out = None
    for t, shown in (("DimExchange", ["ExchangeId", "Name", "Country", "CurrencyId"]), ("DimCurrency", ["CurrencyId", "Symbol", "Name"]),
                     ("DimCompany", ["PK", "CompanyId", "CompanyName", "ExchangeId"]),
                     ("FactEod", ["PK", "Symbol", "ExchangeId", "Date"])):
        cols = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in shown]
        rows = lake.read_staging(t).select(F.lit(t).alias("table_name"), F.concat_ws("|", *cols).alias("content"))
        out = rows if out is None else out.unionByName(rows)
    runs = L.partitions(spark, lake.landing("FactEod")).select(
        F.lit("FactEod runs").alias("table_name"), F.concat_ws("|", "dayId", "runId").alias("content"))
    return out.unionByName(runs)


QUERIES: dict[str, Query] = {
    "page_explode": q_page_explode,
    "page_totals": q_page_totals,
    "page_quarantine": q_page_quarantine,
    "page_requests": q_page_requests,
    "flatten_exchanges": _flatten_q("exchanges"),
    "flatten_eod": _flatten_q("eod"),
    "flatten_bad_dates": _flatten_q("eod", bad_dates=True),
    "flatten_intraday": _flatten_q("intraday"),
    "flatten_dividends": _flatten_q("dividends"),
    "flatten_splits": _flatten_q("splits"),
    "flatten_companies": _flatten_q("tickers"),
    "flatten_currencies": _flatten_q("currencies"),
    "flatten_timezones": _flatten_q("timezones"),
    "calendar_csv": q_calendar_csv,
    "landing_roundtrip": q_landing_roundtrip,
    "landing_append_two_runs": q_landing_append_two_runs,
    "table_location": q_table_location,
    "landing_run_counts": q_landing_run_counts,
    "land_endpoint": q_land_endpoint,
    "stream_land_eod": q_stream_land_eod,
    "partition_listing": q_partition_listing,
    "max_day_run": q_max_day_run,
    "latest_run_rows": q_latest_run_rows,
    "next_run_id": q_next_run_id,
    "distinct_company": _distinct_q("DimCompany"),
    "distinct_currency": _distinct_q("DimCurrency"),
    "distinct_exchange": _distinct_q("DimExchange"),
    "distinct_dividends": _distinct_q("FactDividends"),
    "distinct_eod": _distinct_q("FactEod"),
    "distinct_splits": _distinct_q("FactSplits"),
    "distinct_eod_latest": q_distinct_eod_latest,
    "merge_incremental_eod": _merge_q("FactEod"),
    "merge_incremental_dividends": _merge_q("FactDividends"),
    "merge_incremental_splits": _merge_q("FactSplits"),
    "merge_incremental_company": _merge_q("DimCompany"),
    "merge_incremental_exchange": _merge_q("DimExchange"),
    "merge_incremental_currency": _merge_q("DimCurrency"),
    "merge_full_eod": _merge_q("FactEod", full=True),
    "merge_full_dividends": _merge_q("FactDividends", full=True),
    "merge_full_splits": _merge_q("FactSplits", full=True),
    "merge_full_company": _merge_q("DimCompany", full=True),
    "merge_full_exchange": _merge_q("DimExchange", full=True),
    "merge_full_currency": _merge_q("DimCurrency", full=True),
    "merge_calendar": q_merge_calendar,
    "merge_unmapped_columns": _merge_q(
        "FactEod", mapping={k: v for k, v in COLUMN_MAPPING["FactEod"].items() if k != "Dividend"}),
    "merge_mapping_without_partition": _merge_q(
        "FactDividends", mapping={k: v for k, v in COLUMN_MAPPING["FactDividends"].items() if k != "Date"}),
    "merge_key_without_date": q_merge_key_without_date,
    "reload_matches_incremental": q_reload_matches_incremental,
    "merge_null_keys": _merge_q("FactEod", bad_dates=True),
    "staging_recreated": q_staging_recreated,
    "fact_marks": q_fact_marks,
    "staging_partition_overwrite": q_staging_partition_overwrite,
    "vw_dim_company": _view_q("vw_DimCompany"),
    "vw_dim_company_exchange": _view_q("vw_DimCompanyExchange"),
    "vw_dim_currency": _view_q("vw_DimCurrency"),
    "vw_dim_date": _view_q("vw_DimDate"),
    "vw_dim_exchange": _view_q("vw_DimExchange"),
    "vw_fact_dividends": _view_q("vw_FactDividends"),
    "vw_fact_eod": _view_q("vw_FactEod"),
    "vw_fact_splits": _view_q("vw_FactSplits"),
    "companies_per_exchange": q_companies_per_exchange,
    "companies_per_exchange_multi": q_companies_per_exchange_multi,
    "fact_symbols_distinct": q_fact_symbols_distinct,
    "fact_symbols_for_exchange": q_fact_symbols_for_exchange,
    "missing_companies": q_missing_companies,
    "max_date_per_symbol": q_max_date_per_symbol,
    "high_water_mark": q_high_water_mark,
    "int_to_date": q_int_to_date,
    "symbol_chunks": q_symbol_chunks,
    "fact_request_paths": q_fact_request_paths,
    "dim_request_paths": q_dim_request_paths,
    "load_dim": q_load_dim,
    "load_fact": q_load_fact,
    "batch_outcomes": q_batch_outcomes,
    "update_tables": q_update_tables,
}
