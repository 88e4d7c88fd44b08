"""API pages as a Spark source.

A page is ``{"pagination": {"total": N, ...}, "data": [record, ...]}`` with at
most 1000 records. Pages fetched from the API are landed as JSON-lines files
(one page per line), so every page is an independent input split: a whole
response is read by one distributed scan instead of one job per page.

The records are typed by the endpoint's declared schema (never inferred);
unknown keys are ignored and missing keys are NULL. A page without ``data``
is an error response and fails the read with its text, or is split off (``split_pages``).

What a fetcher lands lies in folders by fetch and by request (``land_fetched``), beside an index of the requests that
each fetch answered, so a load lists and reads only the folders of its own requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.indexing import rank_within
from tidemark.operators.paging import assign_pages, page_requests
from tidemark.schemas import PAGE_SIZE, page_schema
from tidemark.session import exists


def read_pages(spark: SparkSession, path: str | Sequence[str], endpoint: str) -> DataFrame:
    """Pages of one endpoint from JSON-lines files: (page, pagination, data)."""
    return parse_pages(spark.read.text(path).withColumnRenamed("value", "page"), endpoint)


def parse_pages(df: DataFrame, endpoint: str, json_col: str = "page") -> DataFrame:
    """Pages held as JSON text in a column, with their parsed ``pagination`` and ``data``."""
    parsed = F.from_json(F.col(json_col), page_schema(endpoint))
    kept = [c for c in df.columns if c != json_col]
    return df.select(*kept, F.col(json_col).alias("page"), parsed.alias("__p")).select(
        *kept, "page", "__p.pagination", "__p.data")


def _or_fail(value: Column, what: str) -> Column:
    return F.coalesce(value, F.raise_error(F.concat(F.lit(what), F.coalesce("page", F.lit("null")))))


def _data_or_fail() -> Column:
    return _or_fail(F.col("data"), "API page without data: ")


def _total_or_fail() -> Column:
    return _or_fail(F.col("pagination.total"), "API page without a total: ")


def explode_pages(pages: DataFrame) -> DataFrame:
    """One row per record, one column per record field; a page without data fails with its text."""
    return pages.select(F.inline(_data_or_fail()))


def page_totals(pages: DataFrame, *keep: str) -> DataFrame:
    """(total, n_records) per page: the response total and the page's own size; either missing fails."""
    return pages.select(*keep, _total_or_fail().alias("total"), F.size(_data_or_fail()).cast("long").alias("n_records"))


def fail_on_missing_pages(read: DataFrame, requests: DataFrame, excused: bool = False) -> DataFrame:
    """No rows, with the one column ``path`` of ``requests``; fails if a request has no page, or fewer records
    than its total.

    ``read`` (request, offset, total, n_records) has one row per page. The message names the request and the first planned
    page that is missing. With ``excused``, requests of which a page is bad (no total or no records) may be incomplete.
    """
    bad = F.col("total").isNull() | F.col("n_records").isNull()
    answers = read.groupBy("request").agg(F.max("total").alias("total"), F.sum("n_records").alias("got"),
                                          F.collect_set("offset").alias("offsets"), F.max(bad).alias("bad"))
    planned = page_requests(requests.select("path").distinct().join(answers, F.col("path") == F.col("request"), "left")
                            .withColumn("total", F.coalesce("total", F.lit(0))))
    all_pages = F.size("offsets") * PAGE_SIZE >= F.col("total")  # then a page itself is short; the first one stands for it
    short = (F.col("got") < F.col("total")) & (~F.array_contains("offsets", F.col("offset")) | (all_pages & (F.col("page_no") == 0)))
    if excused:
        short = short & ~F.col("bad")
    missing = planned.filter(F.col("request").isNull() | short)
    told = F.concat(F.lit("incomplete response to "), F.col("path"), F.lit(": "), F.coalesce(F.col("got"), F.lit(0)),
                    F.lit(" of "), F.col("total"), F.lit(" records, page at offset "), F.col("offset"))
    return missing.select(F.raise_error(told).cast("string").alias("path"))


#: A page, parsed: what answers a request, from which record on, how much of how many records, and its text if it is bad.
_STAGED = ["request", "offset", "total", "n_records", "data", "bad_page"]


class ErrorPageError(ValueError):
    """A response holds a page without records or without a total."""


def typed_pages(pages: DataFrame, endpoint: str) -> DataFrame:
    """``pages`` (page, and request and offset, if they have them), parsed, in the columns of a staged page."""
    for c, kind in (("request", "string"), ("offset", "long")):
        if c not in pages.columns:
            pages = pages.withColumn(c, F.lit(None).cast(kind))
    parsed = parse_pages(pages.select("request", "offset", "page"), endpoint)
    bad = F.col("data").isNull() | F.col("pagination.total").isNull()
    return parsed.select("request", "offset", F.col("pagination.total").alias("total"), F.size("data").cast("long").alias("n_records"), "data",
                         F.when(bad, F.coalesce("page", F.lit(""))).alias("bad_page")).select(*_STAGED)


def records_or_fail(typed: DataFrame) -> DataFrame:
    """One row per record of typed pages; a bad page fails the job that reads it."""
    good = F.when(F.col("bad_page").isNull(), F.col("data"))
    return typed.select(F.inline(F.coalesce(good, F.raise_error(F.concat(F.lit("bad API page: "), F.substring("bad_page", 1, 2000))))))


def stage_pages(pages: DataFrame, endpoint: str, path: str) -> DataFrame:
    """Parse ``pages`` (page, and request and offset, if they have them) once, into ``path``; the pages as written.

    A page that was landed twice (same request and offset) counts once, a good one before a bad one. Only ids of pages
    are shuffled for that, not their records.
    """
    typed_pages(pages, endpoint).write.parquet(path, compression="zstd")
    staged = pages.sparkSession.read.parquet(path)
    staged = staged.select("*", F.struct(F.col("bad_page").isNotNull(), "_metadata.file_path", "_metadata.row_index").alias("at"))
    copies = (staged.where("request IS NOT NULL").groupBy("request", "offset").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select(F.col("request").alias("r"), F.col("offset").alias("o"), "first"))
    if copies.isEmpty():
        return staged.drop("at")
    extra = (staged.select("request", "offset", "at").join(copies, (F.col("request") == F.col("r")) & F.col("offset").eqNullSafe(F.col("o")))
             .where(F.col("at") != F.col("first")).select(F.col("at").alias("gone")))
    return staged.join(extra, F.col("at") == F.col("gone"), "left_anti").drop("at")


def split_pages(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records of the good pages, bad pages as request, offset and page) of staged pages."""
    good, bad = staged.where("bad_page IS NULL"), staged.where("bad_page IS NOT NULL")
    return good.select(F.inline("data")), bad.select("request", "offset", F.col("bad_page").alias("page"))


def fail_on_error_pages(staged: DataFrame) -> None:
    """Raise with the text of a bad page, if there is one."""
    bad = staged.where("bad_page IS NOT NULL").select("request", "bad_page").first()
    if bad:
        raise ErrorPageError(f"API page without data or without a total, in answer to {bad.request}: {bad.bad_page[:2000]}")


def build_pages(records: DataFrame, record: Column, total: int | Column | None = None,
                page_size: int = PAGE_SIZE, order: Sequence[Column | str] | None = None,
                group: Sequence[str] = ()) -> DataFrame:
    """Serialize records into API pages: one JSON text per page (``page``).

    ``record`` builds the nested record from a row. ``group`` columns name the
    request a record answers: pages never mix requests, and each page's
    ``pagination.total`` is its request's record count (a grouped count joined
    back, so no separate action runs). Each page gathers at most ``page_size``
    records, so no group is unbounded. Adds ``page_no`` (and the group columns): with ``order``, which must
    make a request's records unique, it counts a request's pages, else it only tells pages apart.
    """
    group = list(group)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in (order or [])]
    keys = [f"__o{i}" for i in range(len(order_cols))]
    sel = records.select(*group, record.alias("__rec"), *[c.alias(k) for c, k in zip(order_cols, keys)])
    counts = None
    if total is None:
        counts = sel.groupBy(*group).agg(F.count(F.lit(1)).alias("__total"))
    else:
        sel = sel.withColumn("__total", total if isinstance(total, Column) else F.lit(int(total)).cast("long"))
    if keys:
        paged = rank_within(sel, group, keys, "__pos").withColumn("page_no", F.floor(F.col("__pos") / page_size).cast("long"))
    else:
        paged = assign_pages(sel, page_size, name="page_no").withColumn("__pos", F.monotonically_increasing_id())
    named = [c for c in (*group, "page_no", "__total") if c in paged.columns]
    runs = _runs_of_pages(paged, named)
    if keys or group:
        # A page's records lie beside each other but where a range or partition ends, so few runs make up a page.
        parts = F.array_sort(F.collect_list(F.struct("__first", "__text")))
        wholes = runs.groupBy(*group, "page_no").agg(parts.alias("__runs"), *[F.first(c).alias(c) for c in named if c == "__total"])
        pages = wholes.withColumn("__text", F.array_join("__runs.__text", ","))
    else:  # pages that are cut inside a partition are whole there
        pages = runs
    if counts is not None:  # joined to the pages, not to their records; one response has a single count
        pages = pages.join(counts, group) if group else pages.crossJoin(F.broadcast(counts))
    return pages.select(*group, "page_no", _page_text(F.col("__text"), F.col("__total")))


def _page_text(records: Column, total: Column) -> Column:
    head = F.to_json(F.struct(F.struct(total.cast("long").alias("total")).alias("pagination")))  # {"pagination":{...}}
    return F.concat(head.substr(F.lit(1), F.length(head) - 1), F.lit(',"data":['), records, F.lit("]}")).alias("page")


def _runs_of_pages(paged: DataFrame, place: Sequence[str]) -> DataFrame:
    """The records (``__rec``) of ``paged`` that follow each other in a partition and share ``place``, as one JSON text per run:
    place, position of the first, ``__text``. Nothing is shuffled or sorted; a task holds one batch and one page."""
    rows = paged.select(*place, F.col("__pos").cast("long").alias("__first"), F.coalesce(F.to_json("__rec"), F.lit("null")).alias("__text"))

    def join(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def changes(column):
            here, before = column.slice(1), column.slice(0, len(column) - 1)
            differ = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(here.is_null(), before.is_null()))
            return differ.to_numpy(zero_copy_only=False)

        at, last, texts = None, 0, []  # the run that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            *places, positions, records = batch.columns
            pos = positions.to_numpy()
            ends = np.diff(pos) != 1
            for column in places:
                ends |= changes(column)
            starts = np.concatenate([[0], np.flatnonzero(ends) + 1])
            offsets = pa.array(np.append(starts, len(pos)), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, records), pa.scalar(",", records.type)).to_pylist()
            firsts = list(zip(*[c.take(pa.array(starts)).to_pylist() for c in (*places, positions)]))
            found = []
            for i, (first, text) in enumerate(zip(firsts, joined)):
                goes_on = i == 0 and texts and first[:-1] == at[:-1] and first[-1] == last + 1
                if texts and not goes_on:
                    found.append((*at, ",".join(texts)))
                    texts = []
                at = at if goes_on else first
                texts.append(text)
            last = int(pos[-1])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), batch.schema)], schema=batch.schema)
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*at, ",".join(texts)), batch.schema)], schema=batch.schema)

    return rows.mapInArrow(join, rows.schema)


#: Most pages of a file; a compressed file is read by one task.
PAGES_PER_FILE = 1024


def write_pages(pages: DataFrame, path: str) -> None:
    """Land pages as compressed JSON-lines text, one page per line, in files of bounded size."""
    pages.select("page").write.mode("append").option("maxRecordsPerFile", PAGES_PER_FILE).text(path, compression="gzip")


#: What a fetcher lands for each page it got: the request it answers, from which record on, and its text.
FETCHED = "request STRING, offset LONG, page STRING"
#: Folders that the requests of a fetch are dealt to.
REQUEST_BUCKETS = 32


def request_bucket(request: Column | str) -> Column:
    return F.pmod(F.xxhash64(request), F.lit(REQUEST_BUCKETS)).cast("int")


def land_fetches(pages: DataFrame, path: str, answered: DataFrame | None = None) -> None:
    """Land ``pages`` (FETCHED and fetched_at) as fetchers do: under ``pages/fetched_at=…/bucket=…``, then the requests they
    answer under ``requests/fetched_at=…``. A request counts as answered only from then on. ``answered`` (fetched_at, request)
    names them if they are known; else the pages are made a second time for that."""
    rows = pages.select("fetched_at", "request", "offset", "page", request_bucket("request").alias("bucket"))
    folders = ["fetched_at", "bucket"]
    rows.hint("rebalance", *folders).write.mode("append").partitionBy(*folders).json(f"{path}/pages")
    index = (pages if answered is None else answered).select("fetched_at", "request").distinct()
    index.hint("rebalance", "fetched_at").write.mode("append").partitionBy("fetched_at").json(f"{path}/requests")


def land_fetched(pages: DataFrame, path: str, fetched_at: int, answered: DataFrame | None = None) -> None:
    """``land_fetches`` of one fetch."""
    at = F.lit(int(fetched_at)).cast("long").alias("fetched_at")
    land_fetches(pages.select("*", at), path, None if answered is None else answered.select("request", at))


def answers(spark: SparkSession, path: str, requests: DataFrame) -> DataFrame:
    """(request, fetched_at) of the newest fetch under ``path`` that answered each of ``requests`` (path)."""
    if not exists(spark, f"{path}/requests"):
        return spark.createDataFrame([], "request STRING, fetched_at LONG")
    index = spark.read.schema("request STRING, fetched_at LONG").json(f"{path}/requests")
    wanted = requests.select(F.col("path").alias("request")).distinct()
    return index.join(wanted, "request", "left_semi").groupBy("request").agg(F.max("fetched_at").alias("fetched_at"))


def fetched_pages(spark: SparkSession, path: str, answered: DataFrame) -> DataFrame:
    """(request, offset, page) of the pages of ``answered`` (request, fetched_at), a stored table.

    Only the folders of its fetches are listed, and only those of its requests' buckets are read. What reaches the driver
    for that is fetch times and bucket numbers.
    """
    places = answered.agg(F.collect_set("fetched_at").alias("fetches"), F.collect_set(request_bucket("request")).alias("buckets")).first()
    if not places["fetches"]:
        return spark.createDataFrame([], FETCHED)
    folders = [f"{path}/pages/fetched_at={t}" for t in sorted(places["fetches"])]
    pages = (spark.read.schema(f"{FETCHED}, fetched_at LONG, bucket INT").option("basePath", f"{path}/pages").json(folders)
             .where(F.col("bucket").isin(sorted(places["buckets"]))))
    return pages.join(answered, ["request", "fetched_at"], "left_semi").select("request", "offset", "page")


def write_fetched(pages: DataFrame, path: str, fetched_at: int, page_size: int = PAGE_SIZE, answered: DataFrame | None = None) -> None:
    """``land_fetched`` of the pages of ``build_pages(..., group=["path"])``, which must be built in an order. ``answered`` (path)
    names the requests that they answer, if known."""
    land_fetched(pages.select(F.col("path").alias("request"), (F.col("page_no") * page_size).cast("long").alias("offset"), "page"),
                 path, fetched_at, None if answered is None else answered.select(F.col("path").alias("request")))
