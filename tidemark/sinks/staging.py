"""Current-state staging tables and the upsert that maintains them.

A staging table is served by a catalog view over a version table, an external table over Parquet folders. A merge
never touches a file in use. It writes its result into a new folder, then takes three steps of constant number:

1. The record of the new version (``_current/NNNNNNNN.json``: the folder, for facts that of each date) is created
   beside the folders, if no other merge created it first. This is the commit: a second merge from the same
   version fails and changes nothing.
2. The version's own table is made from the record: one ``CREATE TABLE``, one ``ADD PARTITION`` of all dates.
3. ``CREATE OR REPLACE VIEW`` points the served name at it, so a reader sees all dates of a merge or none.

A driver lost after step 1 leaves the view at the old version; the next merge, or ``recreate``, finishes the switch from the
record. ``recreate`` also brings back tables that the catalog has lost; until then reading them is an error, not an
empty table. The record is not a log: only the newest is ever read.

Facts are partitioned by ``Date``. Only the partitions that the updates touch are read and rewritten; the others'
folders are carried over. The touched dates (one value per partition) become a literal ``IN`` filter, so every scan of
the destination is pruned statically. Where the key implies the date, they are the dates of the updates;
else the dates of matched destination rows are added. To find those, the destination's keys are read within the least and
greatest key of the updates, a literal filter that skips row groups, and matched through a semi-join.

Facts also keep their marks: rows and latest date of each symbol (``_maintain_marks``), which request planning reads in place
of the history.

Frames resolved before a merge keep reading the old version. ``retire`` drops tables and deletes folders that the table
no longer uses and that are older than the operator says; no merge deletes anything.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import bad_casts, fail_on_duplicate_matches, merge_frames, project_updates, source_text
from tidemark.schemas import COLUMN_MAPPING, STAGING_DDL, STAGING_KEY, STAGING_PARTITION, staging_schema
from tidemark.session import create_new, delete_path, exists, list_dirs, list_files, mkdirs, modified_ms, read_text

# Fixed value: the folder name Spark gives the partition of NULL values.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class StagingTable:
    table: str    # logical table, e.g. "FactEod"
    path: str
    database: str

    @property
    def partition(self) -> str | None:
        return STAGING_PARTITION.get(self.table)

    @property
    def name(self) -> str:
        return f"{self.database}.{self.table}"


def staging_table(table: str, path: str, database: str | None = None) -> StagingTable:
    return StagingTable(table, path, database or "stg_" + hashlib.md5(path.encode()).hexdigest()[:10])


class LostTableError(LookupError):
    """The folder holds versions of a table that the catalog doesn't know."""


class ConcurrentMergeError(RuntimeError):
    """Another merge changed the table between this one's read and its commit."""


@dataclass(frozen=True)
class Version:
    """A version's record: its folder (dimensions) or that of each date (facts), and the folder of its marks.

    Folders are relative to the table's; 0 is the table before its first version.
    """
    number: int = 0
    folder: str | None = None
    dates: Mapping[str, str] = field(default_factory=dict)
    marks: str | None = None


def _record(st: StagingTable, number: int) -> str:
    return f"{st.path}/_current/{number:08d}.json"


def current(spark: SparkSession, st: StagingTable) -> Version:
    """The newest version on storage."""
    numbers = [int(n[:8]) for n in list_files(spark, f"{st.path}/_current") if n[:8].isdigit() and n.endswith(".json")]
    return Version(**json.loads(read_text(spark, _record(st, max(numbers))))) if numbers else Version()


def _served(spark: SparkSession, st: StagingTable) -> int:
    """The version that the catalog serves; 0 if it has none."""
    if not spark.catalog.tableExists(st.name):
        return 0
    found = spark.sql(f"SHOW TBLPROPERTIES {st.name}").where("key = 'tidemark.version'").first()
    return int(found["value"]) if found else 0


def read_staging(spark: SparkSession, st: StagingTable) -> DataFrame:
    """The served version; a table without any has no rows. A table that the catalog has lost is an error."""
    if not spark.catalog.tableExists(st.name):
        if current(spark, st).number:
            raise LostTableError(f"{st.path} holds versions of {st.name}, which isn't in the catalog; recreate() brings it back")
        return spark.createDataFrame([], staging_schema(st.table))
    return spark.table(st.name).select(*[f.name for f in staging_schema(st.table).fields])


def read_marks(spark: SparkSession, st: StagingTable) -> DataFrame:
    """(Symbol, n_rows, max_date) of a fact table's newest version, kept by its merges."""
    marks = current(spark, st).marks
    if marks is None:
        return spark.createDataFrame([], MARKS)
    return spark.read.schema(MARKS).option("recursiveFileLookup", True).parquet(f"{st.path}/{marks}")


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in staging_schema(table).fields])


def _new_folder(st: StagingTable, kind: str) -> str:
    return f"{st.path}/{kind}-{uuid.uuid4().hex}"


def _write(st: StagingTable, df: DataFrame) -> str:
    """Write rows into a new folder; rebalance sizes files by bytes, not by (tasks x dates). Facts lie by date and key, so
    that the statistics of row groups tell keys apart."""
    folder, df = _new_folder(st, "v"), _conform(df, st.table)
    if st.partition:
        df.hint("rebalance", st.partition).sortWithinPartitions(st.partition, STAGING_KEY[st.table]).write.partitionBy(st.partition).parquet(folder)
    else:
        df.hint("rebalance").write.parquet(folder)
    return folder


def _value(folder_name: str) -> str:
    text = folder_name.split("=", 1)[1]
    return "null" if text == _NULL_PARTITION else str(int(text))


def _written_dates(spark: SparkSession, st: StagingTable, folder: str) -> dict[str, str]:
    """{date: folder, from the table's} of the partitions written into ``folder``."""
    base = folder.rsplit("/", 1)[1]
    return {_value(n): f"{base}/{n}" for n in list_dirs(spark, folder) if n.startswith(f"{st.partition}=")}


def _commit(spark: SparkSession, st: StagingTable, version: Version) -> None:
    """Record a version as the newest; the one before it must still be so."""
    if not create_new(spark, _record(st, version.number), json.dumps(version.__dict__)):
        raise ConcurrentMergeError(f"another merge made version {version.number} of {st.name} first")


def _switch(spark: SparkSession, st: StagingTable, version: Version) -> None:
    """Serve ``version``: its table, then the view, in a number of statements that doesn't depend on the dates."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {st.database} LOCATION '{st.path}/_db'")
    table = f"{st.database}.{st.table}__v{version.number}"
    partitioned, location = "", f"{st.path}/{version.folder}"
    if st.partition:
        partitioned, location = f"PARTITIONED BY ({st.partition})", f"{st.path}/_base"
        mkdirs(spark, location)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # left by a switch that was cut short
    spark.sql(f"CREATE TABLE {table} ({STAGING_DDL[st.table]}) USING PARQUET {partitioned} LOCATION '{location}'")
    if version.dates:
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(
            f"PARTITION ({st.partition}={v}) LOCATION '{st.path}/{at}'" for v, at in version.dates.items()))
    columns = ", ".join(f.name for f in staging_schema(st.table).fields)
    spark.sql(f"CREATE OR REPLACE VIEW {st.name} TBLPROPERTIES ('tidemark.version' = '{version.number}') "
              f"AS SELECT {columns} FROM {table}")


def recreate(spark: SparkSession, table: str, path: str, database: str | None = None) -> StagingTable:
    """The table as its newest record on storage says, whatever the catalog knows of it."""
    st = staging_table(table, path, database)
    version = current(spark, st)
    if version.number and _served(spark, st) != version.number:
        _switch(spark, st, version)
    return st


def create_staging(spark: SparkSession, table: str, path: str, initial: DataFrame | None = None,
                   database: str | None = None) -> StagingTable:
    """A staging table holding ``initial``; a table that exists gets it as its whole content."""
    st = recreate(spark, table, path, database)
    before = current(spark, st)
    rows = initial if initial is not None else spark.createDataFrame([], staging_schema(table))
    folder = _write(st, rows)
    version = Version(before.number + 1, None if st.partition else folder.rsplit("/", 1)[1])
    if st.partition:
        dates = _written_dates(spark, st, folder)
        version = Version(version.number, None, dates, _whole_marks(spark, st, folder))
    _commit(spark, st, version)
    _switch(spark, st, version)
    return st


def key_implies_partition(table: str, keys: Sequence[str], mapping: Mapping[str, str | Column]) -> bool:
    """Is the key of ``mapping`` the landing key, which ends in the date, and the partition that date?"""
    part, usual = STAGING_PARTITION.get(table), COLUMN_MAPPING[table]
    return bool(part) and list(keys) == ["PK"] and all(
        source_text(mapping.get(c)) == usual[c] for c in ("PK", part))


def merge_into(spark: SparkSession, st: StagingTable, updates: DataFrame, keys: Sequence[str],
               mapping: Mapping[str, str | Column], unique_source: bool = False) -> dict[str, int]:
    """Upsert ``updates`` into the staging table; returns {column: rows whose value couldn't be cast}.

    ``unique_source`` says that no two updates share a key, which spares the check for it.
    """
    before = current(spark, st)
    if before.number and _served(spark, st) != before.number:
        if not spark.catalog.tableExists(st.name):
            read_staging(spark, st)  # tells that the catalog has lost it
        _switch(spark, st, before)  # a merge was lost between its commit and its switch
    dest = read_staging(spark, st)
    observed = Observation()
    counted = updates.observe(observed, *bad_casts(mapping, dest.schema))
    staged_at = _new_folder(st, "_updates")
    try:
        mapped = stage_updates(spark, project_updates(counted, mapping, dest.schema), staged_at)
        if st.partition:
            after = _merge_partitioned(spark, st, before, dest, mapped, keys,
                                       key_implies_partition(st.table, keys, mapping), unique_source)
        else:
            merged = merge_frames(dest, mapped, keys, {c: c for c in mapped.columns}, check=False if unique_source else "inline")
            after = Version(before.number + 1, _write(st, merged).rsplit("/", 1)[1])
        _commit(spark, st, after)
        _switch(spark, st, after)
    finally:
        delete_path(spark, staged_at)
    return {c: n for c, n in observed.get.items() if n}


def stage_updates(spark: SparkSession, mapped: DataFrame, path: str) -> DataFrame:
    """Write the mapped update rows once, beside the table, and read them back.

    The merge reads the update side in several branches (touched dates, keys for the anti-join, inserts,
    duplicate check), each pruned to other columns, so Spark would recompute the source (for a full
    reload: a dedupe of the whole landing table) once per branch.
    """
    mapped.write.parquet(path)
    return spark.read.schema(mapped.schema).parquet(path)


def _key_range(dest: DataFrame, mapped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``dest`` whose keys lie between the least and the greatest of the updates; one row is gathered."""
    ends = mapped.agg(*[f(k).alias(f"{f.__name__}_{i}") for i, k in enumerate(keys) for f in (F.min, F.max)]).first()
    for i, k in enumerate(keys):
        dest = dest.where(F.col(k).between(F.lit(ends[f"min_{i}"]), F.lit(ends[f"max_{i}"])))
    return dest


def _merge_partitioned(spark: SparkSession, st: StagingTable, before: Version, dest: DataFrame, mapped: DataFrame,
                       keys: Sequence[str], implied: bool, unique_source: bool) -> Version:
    """Write the merged partitions; the version with them and the untouched ones."""
    part = st.partition
    touched = mapped.select(part) if part in mapped.columns else None
    if touched is None or not implied:
        within = _key_range(dest, mapped, keys)
        matched = within.join(mapped.select(*keys), list(keys), "left_semi").select(part)
        touched = matched if touched is None else touched.unionByName(matched)
    # Partition values only, at most one per date, reach the driver.
    values = [r[0] for r in touched.where(F.col(part).isNotNull()).distinct().collect()]
    scope = dest.where(F.col(part).isin(values) | F.col(part).isNull())
    merged = merge_frames(scope, mapped, keys, {c: c for c in mapped.columns}, check=False)
    if not unique_source:
        # Every destination row an update can match lies in ``scope``.
        merged = merged.unionByName(fail_on_duplicate_matches(scope, mapped, keys))
    folder = _write(st, merged)
    rewritten = {*map(str, values), "null"}
    dates = {**{v: at for v, at in before.dates.items() if v not in rewritten}, **_written_dates(spark, st, folder)}
    return Version(before.number + 1, None, dates, _maintain_marks(spark, st, before, dest, values, folder))


# ---------------------------------------------------------------- marks

#: Rows and latest date of each symbol of a fact table.
MARKS = "Symbol STRING, n_rows LONG, max_date INT"


def _marks_of(facts: DataFrame) -> DataFrame:
    return facts.groupBy("Symbol").agg(F.count(F.lit(1)).alias("n_rows"), F.max("Date").alias("max_date"))


def _written(spark: SparkSession, st: StagingTable, folder: str) -> DataFrame:
    return spark.read.schema(staging_schema(st.table)).parquet(folder)


def _write_marks(marks: DataFrame, folder: str) -> None:
    marks.select("Symbol", F.col("n_rows").cast("long"), F.col("max_date").cast("int")).write.parquet(folder)


def _whole_marks(spark: SparkSession, st: StagingTable, folder: str) -> str:
    """Marks of a table that is all in ``folder``; returns their folder, from the table's."""
    marks = _new_folder(st, "m")
    _write_marks(_marks_of(_written(spark, st, folder)), f"{marks}/held")
    return marks.rsplit("/", 1)[1]


def _maintain_marks(spark: SparkSession, st: StagingTable, before: Version, dest: DataFrame, values: Sequence[int], folder: str) -> str:
    """The marks after a merge that replaced the rows of ``values`` and of no date, part of ``dest``, by those of ``folder``.

    Only touched dates are read, but for symbols whose latest row was in them and is gone: their untouched dates
    give the next latest one. A symbol without rows has no mark.
    """
    if not before.number:
        return _whole_marks(spark, st, folder)
    touched = F.col("Date").isin(list(values)) | F.col("Date").isNull()
    old = read_marks(spark, st).select("Symbol", F.col("n_rows").alias("n_old"), F.col("max_date").alias("old"))
    gone = _marks_of(dest.where(touched)).toDF("s_gone", "n_gone", "gone")
    new = _marks_of(_written(spark, st, folder)).toDF("s_new", "n_new", "new")
    joined = (old.join(gone, F.col("Symbol").eqNullSafe(F.col("s_gone")), "left")
              .join(new, F.col("Symbol").eqNullSafe(F.col("s_new")), "left"))
    n_rows = F.col("n_old") - F.coalesce("n_gone", F.lit(0)) + F.coalesce("n_new", F.lit(0))
    lost = F.coalesce((F.col("gone") == F.col("old")) & (F.col("new").isNull() | (F.col("new") < F.col("old"))), F.lit(False))
    held = joined.select("Symbol", n_rows.alias("n_rows"), F.greatest("old", "new").alias("max_date"), "new", lost.alias("lost")
                         ).where("n_rows > 0")
    added = new.join(old, F.col("s_new").eqNullSafe(F.col("Symbol")), "left_anti").select(
        F.col("s_new").alias("Symbol"), F.col("n_new").alias("n_rows"), F.col("new").alias("max_date"))
    marks, observed = _new_folder(st, "m"), Observation()
    kept = held.observe(observed, F.count_if("lost").alias("n")).where("NOT lost")
    _write_marks(kept.select("Symbol", "n_rows", "max_date").unionByName(added), f"{marks}/held")
    if observed.get["n"]:
        short = held.where("lost").select("Symbol", "n_rows", "new")
        rest = (dest.where(~touched).join(short.select("Symbol"), "Symbol", "left_semi")
                .groupBy(F.col("Symbol").alias("s_rest")).agg(F.max("Date").alias("rest")))
        found = short.join(rest, F.col("Symbol") == F.col("s_rest"), "left")
        _write_marks(found.select("Symbol", "n_rows", F.greatest("new", "rest").alias("max_date")), f"{marks}/found")
    return marks.rsplit("/", 1)[1]


# ---------------------------------------------------------------- retirement

def retire(spark: SparkSession, st: StagingTable, older_than_seconds: float) -> list[str]:
    """Drop the tables of old versions, and delete folders that the newest doesn't use and that are at least that old;
    returns the folders' names.

    To be called apart from merges, with an age above that of the oldest reader and the longest merge.
    """
    version = current(spark, st)
    used = {at.split("/")[0] for at in [*version.dates.values(), version.folder or "", version.marks or ""]}
    limit = (time.time() - older_than_seconds) * 1000
    for n in list_files(spark, f"{st.path}/_current"):
        if n[:8].isdigit() and int(n[:8]) < version.number and modified_ms(spark, f"{st.path}/_current/{n}") <= limit:
            spark.sql(f"DROP TABLE IF EXISTS {st.database}.{st.table}__v{int(n[:8])}")
            delete_path(spark, f"{st.path}/_current/{n}")
    gone = [n for n in list_dirs(spark, st.path) if n.split("-")[0] in ("v", "m", "_updates") and n not in used
            and exists(spark, f"{st.path}/{n}") and modified_ms(spark, f"{st.path}/{n}") <= limit]
    for n in gone:
        delete_path(spark, f"{st.path}/{n}")
    return gone
