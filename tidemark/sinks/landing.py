"""Landing tables: append-only Parquet partitioned by ``dayId``/``runId``.

A landing table is an external catalog table over a folder, so partitions are
listed from the catalog (``SHOW PARTITIONS``) and the bookkeeping never scans
data. A run the loader writes is registered as one partition
(``register_run``); ``discover`` finds new runs that others wrote, and ``repair`` (``MSCK REPAIR TABLE``, a listing of
every run folder) those under earlier days.
Writes go through Spark's commit protocol: a lost executor's task is simply
retried, and a failed job leaves no partial partition behind.

A run belongs to the attempt that claimed it: a small file beside the run folders, made only if there is none
(``_claims/dayId=…/runId=…``, with the attempt's name). Ids are taken above those of claims, folders and catalog
alike, so two loaders, a loader beside a stream, or a session whose catalog is empty never share one. Only the
attempt that holds a claim may write, or write again, the run's folder; no other landed row is ever replaced.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.runs import max_day_run, parse_partitions
from tidemark.session import create_new, delete_path, exists, list_dirs, list_files, mkdirs, read_text, settings
from tidemark.schemas import LANDING_DDL, RUN_PARTITION_COLUMNS, landing_schema


class RunTakenError(RuntimeError):
    """A run's folder belongs to another attempt."""


@dataclass(frozen=True)
class LandingTable:
    database: str
    table: str   # logical table, e.g. "FactEod"
    path: str

    @property
    def name(self) -> str:
        return f"{self.database}.{self.table}"


def create_landing(spark: SparkSession, database: str, table: str, path: str,
                   database_path: str | None = None) -> LandingTable:
    """``CREATE TABLE IF NOT EXISTS ... USING PARQUET PARTITIONED BY (dayId, runId)``.

    The database gets an explicit location next to the table folder, so no
    warehouse folder appears wherever the driver happens to run.
    """
    mkdirs(spark, path)
    db_path = database_path or f"{path.rstrip('/').rsplit('/', 1)[0]}/_db_{database}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{db_path}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{table} ({LANDING_DDL[table]}, dayId INT, runId INT) "
        f"USING PARQUET PARTITIONED BY ({', '.join(RUN_PARTITION_COLUMNS)}) LOCATION '{path}'")
    return LandingTable(database, table, path)


def table_location(spark: SparkSession, name: str) -> str:
    """Storage location of a catalog table, read from its extended description."""
    row = (spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
           .where(F.col("col_name") == "Location").select("data_type").first())
    if row is None:
        raise ValueError(f"{name} has no storage location")
    return row[0]


def repair(spark: SparkSession, lt: LandingTable) -> None:
    """Register run folders written since the last repair."""
    spark.sql(f"MSCK REPAIR TABLE {lt.name}")


def discover(spark: SparkSession, lt: LandingTable) -> list[tuple[int, int]]:
    """Register runs that others wrote since the catalog's latest day; returns them as (dayId, runId).

    Day folders are listed by name, run folders only of days from the latest registered one on, and the difference is added
    in one statement. Runs that turn up under earlier days need ``repair``.
    """
    known = {(r.dayId, r.runId) for r in partitions(spark, lt).collect()}
    since = max((d for d, _ in known), default=0)
    days = [int(n.split("=", 1)[1]) for n in list_dirs(spark, lt.path) if n.startswith("dayId=") and n.split("=", 1)[1].isdigit()]
    found = [(d, r) for d in sorted(days) if d >= since for r in sorted(_ids(list_dirs(spark, f"{lt.path}/dayId={d}")))]
    fresh = [x for x in found if x not in known]
    if fresh:
        spark.sql(f"ALTER TABLE {lt.name} ADD IF NOT EXISTS " + " ".join(f"PARTITION (dayId={d}, runId={r})" for d, r in fresh))
    spark.catalog.refreshTable(lt.name)  # runs that grew have new files
    return fresh


def register_run(spark: SparkSession, lt: LandingTable, day_id: int, run_id: int) -> bool:
    """Make one just-written run visible: a single catalog entry, not a repair.

    A repair lists every run folder of the table, which grows with its history;
    the loader knows the one run it wrote. A run whose write produced no rows
    has no folder and is not registered (an empty response is no run).
    """
    day_id, run_id = int(day_id), int(run_id)
    if not exists(spark, f"{lt.path}/dayId={day_id}/runId={run_id}"):
        return False
    spark.sql(f"ALTER TABLE {lt.name} ADD IF NOT EXISTS PARTITION (dayId={day_id}, runId={run_id})")
    spark.catalog.refreshTable(lt.name)  # a replayed run has new files
    return True


#: Rows are written by the tasks that hold them if a file gets so many on average, and no task has more runs or rows than
#: its open files can be kept in memory for.
ROWS_PER_FILE, RUNS_PER_TASK, ROWS_PER_TASK = 1 << 16, 64, 1 << 24


def _tasks_hold_runs(rows: DataFrame) -> bool:
    """Would the tasks of ``rows``, which carry ``dayId``/``runId``, write runs in few large files as they are?"""
    files = (rows.select(*RUN_PARTITION_COLUMNS, F.spark_partition_id().alias("task"))
             .groupBy(*RUN_PARTITION_COLUMNS, "task").agg(F.count(F.lit(1)).alias("n")))
    tasks = files.groupBy("task").agg(F.count(F.lit(1)).alias("runs"), F.sum("n").alias("n"))
    found = tasks.agg(F.sum("n").alias("n"), F.sum("runs").alias("files"), F.max("runs").alias("runs"), F.max("n").alias("most")).first()
    return bool(found.n) and found.n >= ROWS_PER_FILE * found.files and found.runs <= RUNS_PER_TASK and found.most <= ROWS_PER_TASK


def append_runs(df: DataFrame, lt: LandingTable) -> None:
    """Append rows that already carry ``dayId``/``runId`` (K1).

    Where a task holds many rows of each run, as in a large table, it writes them as they are, a run's file beside the
    others: nothing is shuffled, sorted or spilled. Else rows are shuffled by run; those files go when the write ends.
    """
    cols = [f.name for f in landing_schema(lt.table).fields]
    out = df.select(*[F.col(c).cast(t.dataType) for c, t in
                      zip(cols, landing_schema(lt.table).fields)])
    during = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if _tasks_hold_runs(out):
        during["spark.sql.maxConcurrentOutputFileWriters"] = str(RUNS_PER_TASK)
    else:
        # Rebalanced by run, so AQE sizes the write tasks by bytes and a run becomes a
        # few large files rather than one small file per (task, run).
        out = out.hint("rebalance", *RUN_PARTITION_COLUMNS)
    with settings(df.sparkSession, during):
        out.write.mode("append").partitionBy(*RUN_PARTITION_COLUMNS).parquet(lt.path, compression="zstd")


def claim_path(lt: LandingTable, day_id: int, run_id: int) -> str:
    return f"{lt.path}/_claims/dayId={int(day_id)}/runId={int(run_id)}"


def new_attempt() -> str:
    return uuid.uuid4().hex


def _ids(names: list[str]) -> list[int]:
    return [int(n.split("=", 1)[1]) for n in names if n.startswith("runId=") and n.split("=", 1)[1].isdigit()]


def _runs_of(spark: SparkSession, lt: LandingTable, day_id: int) -> list[int]:
    """Run ids of a day that have a claim, a folder or a catalog entry."""
    known = spark.sql(f"SHOW PARTITIONS {lt.name} PARTITION (dayId={int(day_id)})").collect()
    return (_ids(list_files(spark, f"{lt.path}/_claims/dayId={int(day_id)}"))
            + _ids(list_dirs(spark, f"{lt.path}/dayId={int(day_id)}"))
            + _ids([part for r in known for part in r[0].split("/")]))


def claim_run(spark: SparkSession, lt: LandingTable, day_id: int, attempt: str) -> int:
    """A run id of ``day_id`` for this attempt alone; an attempt that claimed one before gets it again."""
    claims = f"{lt.path}/_claims/dayId={int(day_id)}"
    mine = [i for i in _ids(list_files(spark, claims)) if read_text(spark, f"{claims}/runId={i}") == attempt]
    if mine:
        return max(mine)
    run_id = max(_runs_of(spark, lt, day_id), default=0) + 1
    while not create_new(spark, claim_path(lt, day_id, run_id), attempt):
        run_id += 1
    return run_id


def release_run(spark: SparkSession, lt: LandingTable, day_id: int, run_id: int, attempt: str) -> None:
    """Give up this attempt's claim of a run that landed nothing; what a failed write left in its folder goes too."""
    at, folder = claim_path(lt, day_id, run_id), run_path(lt, day_id, run_id)
    if not exists(spark, at) or read_text(spark, at) != attempt:
        return
    if exists(spark, folder) and not list_files(spark, folder):
        delete_path(spark, folder)
    if not exists(spark, folder):
        delete_path(spark, at)


def _hold(spark: SparkSession, lt: LandingTable, day_id: int, run_id: int, attempt: str) -> None:
    """Make sure that the run is this attempt's, claiming it if nobody did and nothing is there."""
    at = claim_path(lt, day_id, run_id)
    if not exists(spark, at):
        if exists(spark, run_path(lt, day_id, run_id)):
            raise RunTakenError(f"{run_path(lt, day_id, run_id)} was written without a claim")
        if create_new(spark, at, attempt):
            return
    if read_text(spark, at) != attempt:
        raise RunTakenError(f"{run_path(lt, day_id, run_id)} is claimed by another attempt")


def append_run(df: DataFrame, lt: LandingTable, day_id: int, run_id: int, attempt: str | None = None,
               spread: bool = True) -> int:
    """Write one run into its own folder; returns its rows.

    Without ``spread`` every task of ``df`` writes its rows as they are, as suits one whose tasks are of even size. What the same attempt wrote there before is replaced; a run of another attempt is an error. A response without
    records is no run: it leaves no folder.
    """
    spark = df.sparkSession
    _hold(spark, lt, day_id, run_id, attempt or new_attempt())
    fields = landing_schema(lt.table, with_run=False).fields
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    # The run's folder is its identity; an unkeyed rebalance spreads the rows over write tasks.
    folder, observed = run_path(lt, day_id, run_id), Observation()
    out = out.hint("rebalance") if spread else out
    out.observe(observed, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder, compression="zstd")
    if not observed.get["n"]:
        delete_path(spark, folder)
    return observed.get["n"]


def run_path(lt: LandingTable, day_id: int, run_id: int) -> str:
    return f"{lt.path}/dayId={int(day_id)}/runId={int(run_id)}"


def read_landing(spark: SparkSession, lt: LandingTable) -> DataFrame:
    return spark.table(lt.name)


def partitions(spark: SparkSession, lt: LandingTable) -> DataFrame:
    """(dayId, runId) of every landed run, from the catalog."""
    return parse_partitions(spark.sql(f"SHOW PARTITIONS {lt.name}"))


def latest_run(spark: SparkSession, lt: LandingTable) -> tuple[int, int] | None:
    """(dayId, runId) of the newest run, numerically; None when nothing landed (O1)."""
    row = max_day_run(partitions(spark, lt)).first()
    return None if row is None else (int(row.dayId), int(row.runId))


def latest_run_rows(spark: SparkSession, lt: LandingTable) -> DataFrame:
    """Rows of the newest run; literal partition filters prune to one folder."""
    latest = latest_run(spark, lt)
    if latest is None:
        raise ValueError(f"{lt.name} has no runs")
    day, run = latest
    return read_landing(spark, lt).where((F.col("dayId") == day) & (F.col("runId") == run))


def next_run_id(spark: SparkSession, lt: LandingTable, day_id: int) -> int:
    """1 + the highest run of ``day_id`` (numerically) that is registered, on storage or claimed, or 1 (O2).

    Only a look: a loader takes its id by ``claim_run``.
    """
    return max(_runs_of(spark, lt, day_id), default=0) + 1
