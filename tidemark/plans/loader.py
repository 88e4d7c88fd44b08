"""Config-driven loads: request -> pages -> landing run -> upsert.

A config has the shape of the YAML batch files::

    {"general": {"landing_database_name": "landing", "staging_database_name": "staging", ...},
     "table_type": "Fact" | "Dim",
     "tables": [{"is_enabled": True, "is_full_reload": False, "table_name": "FactEod",
                 "endpoint_name": "eod", "history_start_date": "2010-01-01",
                 "exchanges": "'XNAS', 'XNYS'", "merge_keys": "destination.PK = updates.pk",
                 "column_mapping": {"PK": "updates.pk", ...}}, ...]}

Pages come from a ``PageSource``: anything with ``fetch(table, endpoint, requests) -> DataFrame`` of the
pages that answer the planned requests (request, offset, page JSON text). The HTTP client that fills
it is outside this library; ``FilePageSource`` reads pages that a fetcher landed as JSON-lines files. A
load fails if a request has no page, or fewer records than the total that its pages name.

Tables of a batch load concurrently; the outcome of each is a row, and one failure doesn't end the others.

Per table the driver holds one run id and one (dayId, runId) pair; requests,
high-water marks, pages, flattening and the merge are DataFrame plans.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe_newest, dedupe_runs
from tidemark.operators.flatten import flatten
from tidemark.operators.incremental import exchange_groups
from tidemark.operators.upsert import source_text
from tidemark.plans.requests import dim_requests, fact_requests
from tidemark.plans.views import create_analytics_views, create_distinct_views, distinct_view, tie_columns
from tidemark.schemas import (COLUMN_MAPPING, DISTINCT_VIEW_KEY, ENDPOINT_OF_TABLE, LANDING_KEY, STAGING_KEY,
                              landing_columns)
from tidemark.session import delete_path, exists, list_dirs
from tidemark.sinks import landing as L
from tidemark.sinks import staging as S
from tidemark.sources.pages import (answers, fail_on_error_pages, fail_on_missing_pages, fetched_pages, records_or_fail, split_pages, stage_pages,
                                     typed_pages)


class PageSource(Protocol):
    def fetch(self, table: str, endpoint: str, requests: DataFrame) -> DataFrame: ...


@dataclass
class FilePageSource:
    """Pages that a fetcher wrote to ``{root}/{table}/`` (``sources.pages.land_fetched``).

    Of the pages of each planned request, those of its newest fetch answer it. Folders of other fetches aren't listed,
    those of other requests' buckets aren't read.
    """
    spark: SparkSession
    root: str

    def fetch(self, table: str, endpoint: str, requests: DataFrame) -> DataFrame:
        at = f"{self.root}/{table}"
        return fetched_pages(self.spark, at, answers(self.spark, at, requests).checkpoint(eager=True))


@dataclass
class Lake:
    """Where landing and staging tables and the analytics views live (a folder under the shared dir)."""
    spark: SparkSession
    root: str
    landing_db: str = "landing"
    staging_db: str = "staging"
    analytics_db: str = "analytics"
    _landing: dict = field(default_factory=dict)

    def landing(self, table: str) -> L.LandingTable:
        if table not in self._landing:
            self._landing[table] = L.create_landing(self.spark, self.landing_db, table,
                                                    f"{self.root}/landing/{table}")
        return self._landing[table]

    def staging(self, table: str) -> S.StagingTable:
        return S.staging_table(table, f"{self.root}/staging/{table}", self.staging_db)

    def read_staging(self, table: str) -> DataFrame:
        return S.read_staging(self.spark, self.staging(table))

    def read_marks(self, table: str) -> DataFrame:
        return S.read_marks(self.spark, self.staging(table))

    def recreate(self) -> None:
        """Bring back the landing and staging tables that lie under ``root`` and that the catalog doesn't know."""
        for table in list_dirs(self.spark, f"{self.root}/landing"):
            if table in LANDING_KEY:
                L.repair(self.spark, self.landing(table))
        for table in list_dirs(self.spark, f"{self.root}/staging"):
            S.recreate(self.spark, table, f"{self.root}/staging/{table}", self.staging_db)

    def create_views(self) -> list[str]:
        """The analytics views over the staging tables that exist, and the distinct views of the landing tables."""
        distinct = [t for t in self._landing if t in DISTINCT_VIEW_KEY]
        return [*create_analytics_views(self.spark, self.staging_db, self.analytics_db, f"{self.root}/analytics"),
                *create_distinct_views(self.spark, self.landing_db, distinct)]


_KEY_TERM = re.compile(r"destination\.`?(\w+)`?\s*=")


def merge_key_columns(merge_keys: str | list[str]) -> list[str]:
    """``"destination.PK = updates.pk"`` -> ``["PK"]``; lists pass through."""
    if isinstance(merge_keys, str):
        found = _KEY_TERM.findall(merge_keys)
        return found or [merge_keys.strip()]
    return list(merge_keys)


def run_day(now: str) -> int:
    """``2022-07-03`` -> ``20220703``."""
    return int(now.replace("-", ""))


def _land_unnamed(lt: L.LandingTable, pages: DataFrame, endpoint: str, day_id: int, run_id: int, attempt: str) -> int:
    """Land pages that name no request in the one job that parses them; returns the run's rows. A bad page fails that job, which
    lands nothing, and is then looked for, to be named by the error."""
    typed = typed_pages(pages, endpoint)
    try:
        return L.append_run(flatten(records_or_fail(typed), endpoint), lt, day_id, run_id, attempt, spread=False)
    except Exception:
        fail_on_error_pages(typed)
        raise


def land_pages(spark: SparkSession, lt: L.LandingTable, pages: DataFrame, endpoint: str,
               day_id: int, requests: DataFrame | None = None, attempt: str | None = None,
               quarantine: str | None = None) -> int:
    """Flatten a response's pages into one new run of a landing table (K4); returns the run id.

    The pages are read and parsed once, into a folder that goes at the end; one distributed write lands the records. Pages
    that name no request have nothing to be matched with, and are parsed and landed by one write, without that folder. An empty
    response writes no run, so the previous run stays the latest one. A bad page (an error, or no total) fails the load
    with its text, or, with ``quarantine``, is written there by day and run, while the others land. With ``requests``
    an incomplete response fails the write, and no run is landed; those with a quarantined page may be incomplete.
    The run is claimed first: a caller that retries with the ``attempt`` it named replaces its own run, and no other.
    """
    attempt = attempt or L.new_attempt()
    run_id = L.claim_run(spark, lt, day_id, attempt)
    # A retry's pages are checked before they replace the rows that the attempt landed.
    unnamed = requests is None and quarantine is None and "request" not in pages.columns and not exists(spark, L.run_path(lt, day_id, run_id))
    staged_at = f"{lt.path}/_pages/{uuid.uuid4().hex}"
    try:
        if unnamed:
            landed = _land_unnamed(lt, pages, endpoint, day_id, run_id, attempt)
        else:
            staged = stage_pages(pages, endpoint, staged_at)
            if quarantine is None:
                fail_on_error_pages(staged)
            good, bad = split_pages(staged)
            records = flatten(good, endpoint)
            if requests is not None:
                missing = fail_on_missing_pages(staged.select("request", "offset", "total", "n_records"), requests, quarantine is not None)
                first, *rest = records.schema.fields
                records = records.unionByName(missing.select(
                    F.col("path").cast(first.dataType).alias(first.name), *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest]))
            landed = L.append_run(records, lt, day_id, run_id, attempt, spread=False)  # the staged files are split by size
            if quarantine is not None:
                bad.write.mode("overwrite").json(f"{quarantine}/dayId={int(day_id)}/runId={run_id}")
    except BaseException:
        L.release_run(spark, lt, day_id, run_id, attempt)
        raise
    finally:
        delete_path(spark, staged_at)
    if landed:
        L.register_run(spark, lt, day_id, run_id)
    else:
        L.release_run(spark, lt, day_id, run_id, attempt)
    return run_id


def merge_source(spark: SparkSession, lt: L.LandingTable, full_reload: bool,
                 recency: str = "latest") -> DataFrame:
    """Landing rows to merge: every key's newest row (full) or the latest run's rows, one per key.

    Both use one total order, ties within a run going by the row's own values, so a reload right
    after an incremental merge changes nothing. ``recency="reference"`` reads the distinct view as
    written; companies, which that view keys by symbol, are deduped by ``pk`` in its order. Rows with a
    NULL key are all kept, except by the view.
    """
    key = LANDING_KEY[lt.table]
    cols, ties = landing_columns(lt.table), tie_columns(lt.table, key)
    if not full_reload:
        return dedupe_runs(L.latest_run_rows(spark, lt), key, "latest", ties, keep_null_keys=True).select(*cols)
    if recency == "reference" and lt.table != "DimCompany":
        create_distinct_views(spark, lt.database, [lt.table])
        return spark.table(distinct_view(lt.database, lt.table)).select(*cols)
    if recency == "latest":
        return dedupe_newest(L.read_landing(spark, lt), key, ties, keep_null_keys=True).select(*cols)
    return dedupe_runs(L.read_landing(spark, lt), key, recency, ties).select(*cols)


def _mapping(cfg: Mapping, table: str) -> dict:
    return dict(cfg.get("column_mapping") or COLUMN_MAPPING[table])


def _keys(cfg: Mapping, table: str) -> list[str]:
    return merge_key_columns(cfg.get("merge_keys") or [STAGING_KEY[table]])


def is_unique_source(table: str, keys: list[str], mapping: Mapping) -> bool:
    """Does the merge key come from the landing key, of which ``merge_source`` keeps one row each?"""
    return keys == [STAGING_KEY[table]] and source_text(mapping.get(keys[0])) == LANDING_KEY[table]


def merge_landed(spark: SparkSession, lake: Lake, table: str, cfg: Mapping, recency: str = "latest") -> dict[str, int]:
    """Merge a landing table's rows into its staging table as the config says; returns failed casts by column."""
    keys, mapping = _keys(cfg, table), _mapping(cfg, table)
    source = merge_source(spark, lake.landing(table), bool(cfg.get("is_full_reload")), recency)
    return S.merge_into(spark, lake.staging(table), source, keys, mapping, is_unique_source(table, keys, mapping))


def plan_fact(spark: SparkSession, lake: Lake, cfg: Mapping, now: str) -> DataFrame:
    """The requests of a fact table's next load (path and its parts), written once in the shared folder."""
    table = cfg["table_name"]
    groups = exchange_groups(spark, {table: cfg["exchanges"]})
    requests = fact_requests(groups, lake.read_staging("DimCompany"), lake.read_marks(table),
                             cfg.get("endpoint_name") or ENDPOINT_OF_TABLE[table], cfg["history_start_date"], now)
    return requests.checkpoint(eager=True)  # one row per 99 symbols, read by the fetch and the check


def load_fact(spark: SparkSession, lake: Lake, cfg: Mapping, source: PageSource, now: str) -> int:
    """Plan requests from the high-water mark, land their pages, upsert (C11)."""
    table = cfg["table_name"]
    endpoint = cfg.get("endpoint_name") or ENDPOINT_OF_TABLE[table]
    requests = plan_fact(spark, lake, cfg, now)
    run_id = land_pages(spark, lake.landing(table), source.fetch(table, endpoint, requests), endpoint, run_day(now),
                        requests=requests)
    merge_landed(spark, lake, table, cfg)
    return run_id


def load_dim(spark: SparkSession, lake: Lake, cfg: Mapping, source: PageSource, now: str,
             exchanges: Sequence[str] | None = None) -> int:
    """Request the whole dimension, land, upsert (C12). Companies are requested per exchange, those of
    ``exchanges`` (default: the config's one) in one run and one merge."""
    table = cfg["table_name"]
    endpoint = ENDPOINT_OF_TABLE[table]
    wanted = None
    if table == "DimCompany":
        wanted = spark.createDataFrame([(x,) for x in exchanges or [cfg["exchange"]]], "ExchangeId STRING")
    requests = dim_requests(spark, [table], wanted)
    run_id = land_pages(spark, lake.landing(table), source.fetch(table, endpoint, requests), endpoint, run_day(now),
                        requests=requests)
    merge_landed(spark, lake, table, cfg)
    return run_id


@dataclass(frozen=True)
class Outcome:
    """What a load of a table came to: its run, or the error that ended it."""
    table_name: str
    scope: str        # the exchanges it asked for
    status: str       # "loaded" or "failed"
    run_id: int | None = None
    error: str | None = None


class BatchError(RuntimeError):
    """Some loads of a batch failed, the others are done; ``outcomes`` has them all."""

    def __init__(self, outcomes: Sequence[Outcome]):
        failed = [o for o in outcomes if o.status == "failed"]
        super().__init__("; ".join(f"{o.table_name}:{o.scope} failed: {o.error}" for o in failed))
        self.outcomes = list(outcomes)


def outcome_table(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """The outcomes of a batch as rows."""
    return spark.createDataFrame([(o.table_name, o.scope, o.status, o.run_id, o.error) for o in outcomes],
                                 "table_name STRING, scope STRING, status STRING, run_id INT, error STRING")


def _batches(config: Mapping) -> list[list[list[Mapping]]]:
    """Enabled entries by table, in their order; a dimension's entries that differ in the exchange only are one load."""
    tables: dict[str, list[list[Mapping]]] = {}
    for cfg in config.get("tables", []):
        if cfg.get("is_enabled") is not True:
            continue
        loads = tables.setdefault(cfg["table_name"], [])
        same = {k: v for k, v in cfg.items() if k != "exchange"}
        if config["table_type"] == "Dim" and loads and {k: v for k, v in loads[-1][0].items() if k != "exchange"} == same:
            loads[-1].append(cfg)
        else:
            loads.append([cfg])
    return list(tables.values())


def load_batch(spark: SparkSession, config: Mapping, source: PageSource, lake: Lake, now: str,
               concurrent: int = 4) -> list[Outcome]:
    """Load every enabled table of a Dim or Fact config, then create the views.

    Up to ``concurrent`` tables load at a time, each in a scheduler pool of its own; loads of one table follow each other.
    A load that fails doesn't end the others.
    """
    kind = config.get("table_type")
    if kind not in ("Dim", "Fact"):
        raise ValueError(f"table_type must be 'Dim' or 'Fact', got {kind!r}")
    batches = _batches(config)
    for loads in batches:
        lake.landing(loads[0][0]["table_name"])  # tables are made here, one after the other

    def load(cfgs: list[Mapping]) -> list[Outcome]:
        table = cfgs[0]["table_name"]
        scopes = [str(c["exchanges"] if kind == "Fact" else c.get("exchange", "")) for c in cfgs]
        try:
            run = load_fact(spark, lake, cfgs[0], source, now) if kind == "Fact" else \
                load_dim(spark, lake, cfgs[0], source, now, [c.get("exchange") for c in cfgs])
        except Exception as e:  # noqa: BLE001 - reported as this load's outcome
            return [Outcome(table, s, "failed", None, f"{type(e).__name__}: {e}"[:4000]) for s in scopes]
        return [Outcome(table, s, "loaded", run) for s in scopes]

    def load_all(loads: list[list[Mapping]]) -> list[Outcome]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", loads[0][0]["table_name"])
        return [o for cfgs in loads for o in load(cfgs)]

    with ThreadPoolExecutor(max(1, concurrent)) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(load_all), loads) for loads in batches]
        outcomes = [o for f in done for o in f.result()]
    lake.create_views()
    return outcomes


def update_tables(spark: SparkSession, config: Mapping, source: PageSource, lake: Lake,
                  now: str) -> dict[str, int]:
    """``load_batch``, returning the run ids; after all loads have ended, a failed one raises ``BatchError``."""
    outcomes = load_batch(spark, config, source, lake, now)
    if any(o.status == "failed" for o in outcomes):
        raise BatchError(outcomes)
    return {f"{o.table_name}:{o.scope}": o.run_id for o in outcomes}
