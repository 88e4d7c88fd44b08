"""Targeted checks: traps where a wrong answer differs from the right one."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe_runs, keep_first
from tidemark.operators.indexing import chunk_within, with_global_index
from tidemark.operators.paging import page_requests
from tidemark.operators.upsert import DuplicateMatchError, merge_frames
from tidemark.session import shared_dir
from tidemark.sinks import landing as L
from tidemark.sinks import staging as S
from tidemark.sources import pages as P


def test_run_ids_are_numeric(spark):
    """Run 10 is later than run 9 (text order would say otherwise)."""
    path = shared_dir(spark, "t", "runs")
    lt = L.create_landing(spark, "t_runs", "DimCurrency", path)
    rows = spark.createDataFrame([("C", "$", "n")], "code string, symbol string, name string")
    for run in (1, 2, 9, 10):
        L.append_run(rows, lt, 20220701, run)
    L.repair(spark, lt)
    assert L.latest_run(spark, lt) == (20220701, 10)
    assert L.next_run_id(spark, lt, 20220701) == 11
    assert L.next_run_id(spark, lt, 20220702) == 1


def test_table_location(spark):
    path = shared_dir(spark, "t", "loc")
    lt = L.create_landing(spark, "tm_loc", "FactSplits", path)
    assert L.table_location(spark, lt.name).rstrip("/").endswith(path.rsplit("/", 1)[1])


def test_empty_response_writes_no_run(spark):
    from tidemark.plans.loader import land_pages
    path = shared_dir(spark, "t", "empty")
    lt = L.create_landing(spark, "t_empty", "DimCurrency", path)
    rec = spark.createDataFrame([("C1", "$", "one")], "code string, symbol string, name string")
    pages = P.build_pages(rec, F.struct("code", "symbol", "name"))
    land_pages(spark, lt, pages, "currencies", 20220701)
    empty = P.build_pages(rec.limit(0), F.struct("code", "symbol", "name"), total=0)
    land_pages(spark, lt, empty, "currencies", 20220701)
    assert L.latest_run(spark, lt) == (20220701, 1)
    assert L.latest_run_rows(spark, lt).count() == 1


def test_page_without_data_fails(spark):
    bad = spark.createDataFrame([('{"error": {"code": "invalid_access_key"}}',)], "page string")
    with pytest.raises(Exception, match="API page without data"):
        P.explode_pages(P.parse_pages(bad, "currencies")).collect()


def test_page_request_plan(spark):
    totals = spark.createDataFrame([(t,) for t in (0, 1, 1000, 1001, 2500)], "total long")
    got = sorted((r.total, r.offset, r.limit) for r in page_requests(totals).collect())
    assert got == [(0, 0, 0), (1, 0, 1), (1000, 0, 1000), (1001, 0, 1000), (1001, 1000, 1000),
                   (2500, 0, 1000), (2500, 1000, 1000), (2500, 2000, 1000)]


def test_pages_roundtrip_and_limit(spark):
    rec = spark.range(2345).select(F.col("id").cast("string").alias("code"),
                                   F.lit("$").alias("symbol"), F.lit("n").alias("name"))
    pages = P.build_pages(rec, F.struct("code", "symbol", "name"), page_size=1000)
    parsed = P.parse_pages(pages, "currencies")
    sizes = sorted(r.n_records for r in P.page_totals(parsed).collect())
    assert max(sizes) <= 1000 and sum(sizes) == 2345
    assert P.explode_pages(parsed).select("code").distinct().count() == 2345


def test_flatten_exchanges_drops_missing_mic(spark):
    from tidemark.operators.flatten import flatten_exchanges
    page = ('{"pagination": {"total": 2}, "data": ['
            '{"name": "A", "mic": "XA", "currency": {"code": "USD"}, "timezone": {"timezone": "T", "abbr": "E"}},'
            '{"name": "B", "currency": {"code": "EUR"}}]}')
    recs = P.explode_pages(P.parse_pages(spark.createDataFrame([(page,)], "page string"), "exchanges"))
    rows = flatten_exchanges(recs).collect()
    assert [(r.mic, r.currencyCode, r.timezoneAbbr) for r in rows] == [("XA", "USD", "E")]


def test_eod_int_prices_and_junk_dates(spark):
    """JSON ints read as FLOAT; junk dates give NULL date and NULL key."""
    from tidemark.operators.flatten import flatten_eod
    page = ('{"pagination": {"total": 2}, "data": ['
            '{"open": 1, "symbol": "S", "exchange": "X", "date": "2022-07-06T00:00:00+0000"},'
            '{"open": 2.5, "symbol": "S", "exchange": "X", "date": "junk"}]}')
    recs = P.explode_pages(P.parse_pages(spark.createDataFrame([(page,)], "page string"), "eod"))
    rows = sorted(flatten_eod(recs).collect(), key=lambda r: r.open)
    assert (rows[0].open, rows[0].date, rows[0].pk) == (1.0, 20220706, "S_X_20220706")
    assert (rows[1].open, rows[1].date, rows[1].pk) == (2.5, None, None)


def test_dedupe_reference_vs_latest(spark):
    """As written, DESC binds to runId only: the oldest day's last run wins."""
    df = spark.createDataFrame([("k", 20220701, 2, "old"), ("k", 20220702, 1, "new")],
                               "pk string, dayId int, runId int, v string")
    assert dedupe_runs(df, "pk", "reference").first().v == "old"
    assert dedupe_runs(df, "pk", "latest").first().v == "new"


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    """A hot key (a third of all rows) reaches the shuffle as one row per map task."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
                                  .alias("pk"), (F.col("id") % 7).cast("int").alias("dayId"),
                                  (F.col("id") % 11).cast("int").alias("runId"), F.col("id").alias("tie"))
    out = dedupe_runs(df, "pk", "latest", ["tie"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan, plan
    assert out.count() == 2001
    # newest day, then newest run, then the smallest tie
    assert out.where(F.col("pk") == "hot").first().tie == min((-(i % 7), -(i % 11), i) for i in range(0, 3000, 3))[2]


def test_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, t int")
    assert keep_first(df, ["k"], [F.asc("t")]).count() == 2
    assert keep_first(df, ["k"], [F.asc("t")], keep_null_keys=True).count() == 3


def test_global_index_matches_row_number(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"),
                                      F.lit("x" * 50).alias("payload"))
        got = with_global_index(df, ["k"], "idx")
        # a narrower branch and a wider branch of the same plan must agree
        assert got.select("k", "idx").where(F.col("k") != F.col("idx")).count() == 0
        assert got.where(F.col("k") != F.col("idx")).count() == 0
        assert got.count() == 5000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_chunks_partition_each_group(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("g"),
                                  F.format_string("S%04d", "id").alias("sym"))
    ch = chunk_within(df, ["g"], ["sym"], 99)
    sizes = ch.groupBy("g", "chunk_no").count().collect()
    assert max(r["count"] for r in sizes) <= 99
    assert sum(r["count"] for r in sizes) == 1000
    w = Window.partitionBy("g").orderBy("sym")
    expect = df.withColumn("e", ((F.row_number().over(w) - 1) / 99).cast("int"))
    assert ch.join(expect, ["g", "sym"]).where(F.col("e") != F.col("chunk_no")).count() == 0


def _dest(spark):
    return spark.createDataFrame([("a", 1.0, 10.0), ("b", 2.0, 20.0), (None, 3.0, 30.0)],
                                 "PK string, Open float, Dividend float")


def test_merge_semantics(spark):
    upd = spark.createDataFrame([("a", 5.0), ("c", 6.0), (None, 7.0)], "pk string, open double")
    out = merge_frames(_dest(spark), upd, ["PK"], {"PK": "updates.pk", "Open": "updates.open"})
    got = sorted((r.PK or "", r.Open, r.Dividend) for r in out.collect())
    # matched keeps the unmapped column, inserts get NULL, NULL keys never match
    assert got == [("", 3.0, 30.0), ("", 7.0, None), ("a", 5.0, 10.0), ("b", 2.0, 20.0), ("c", 6.0, None)]


def test_merge_duplicate_match_is_an_error(spark):
    upd = spark.createDataFrame([("a", 5.0), ("a", 6.0)], "pk string, open double")
    with pytest.raises(DuplicateMatchError):
        merge_frames(_dest(spark), upd, ["PK"], {"PK": "pk", "Open": "open"})
    # duplicate keys that match nothing are all inserted
    upd2 = spark.createDataFrame([("z", 5.0), ("z", 6.0)], "pk string, open double")
    assert merge_frames(_dest(spark), upd2, ["PK"], {"PK": "pk", "Open": "open"}).count() == 5


def test_fact_merge_rewrites_only_touched_partitions_and_is_idempotent(spark):
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "splits"),
                          spark.createDataFrame([("A_20220101", "A", 1.0, 20220101),
                                                 ("A_20220201", "A", 2.0, 20220201)],
                                                "PK string, Symbol string, SplitFactor float, Date int"))
    upd = spark.createDataFrame([("A_20220201", "A", 3.0, 20220201), ("B_20220301", "B", 4.0, 20220301)],
                                "pk string, symbol string, split_factor double, date int")
    mapping = {"PK": "pk", "Symbol": "symbol", "SplitFactor": "split_factor", "Date": "date"}
    S.merge_into(spark, st, upd, ["PK"], mapping)
    first = sorted(tuple(r) for r in S.read_staging(spark, st).collect())
    S.merge_into(spark, st, upd, ["PK"], mapping)
    second = sorted(tuple(r) for r in S.read_staging(spark, st).collect())
    assert first == second == [("A_20220101", "A", 1.0, 20220101), ("A_20220201", "A", 3.0, 20220201),
                               ("B_20220301", "B", 4.0, 20220301)]


def test_fact_merge_moving_rows_leave_no_stale_partition(spark):
    # keyed by Symbol, so the key does not imply the Date partition
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "moved"),
                          spark.createDataFrame([("A_1", "A", 1.0, 20220101), ("B_1", "B", 2.0, 20220101),
                                                 ("C_2", "C", 3.0, 20220201), ("D_0", "D", 4.0, None)],
                                                "PK string, Symbol string, SplitFactor float, Date int"))
    # C leaves 20220201 empty, A leaves B behind in 20220101, D leaves the NULL partition empty
    upd = spark.createDataFrame([("C_3", "C", 5.0, 20220301), ("A_3", "A", 6.0, 20220301),
                                 ("D_4", "D", 7.0, 20220401)],
                                "pk string, symbol string, split_factor double, date int")
    mapping = {"PK": "pk", "Symbol": "symbol", "SplitFactor": "split_factor", "Date": "date"}
    want = [("A_3", "A", 6.0, 20220301), ("B_1", "B", 2.0, 20220101), ("C_3", "C", 5.0, 20220301),
            ("D_4", "D", 7.0, 20220401)]
    for _ in range(2):   # idempotent
        S.merge_into(spark, st, upd, ["Symbol"], mapping)
        assert sorted(tuple(r) for r in S.read_staging(spark, st).collect()) == want


def test_fact_merge_scans_only_touched_partitions(spark, monkeypatch):
    """Every destination scan of the merge's write is pruned to the touched date."""
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "prune"),
                          spark.createDataFrame([("A_20220101", "A", 1.0, 20220101),
                                                 ("A_20220201", "A", 2.0, 20220201),
                                                 ("A_20220301", "A", 3.0, 20220301)],
                                                "PK string, Symbol string, SplitFactor float, Date int"))
    upd = spark.createDataFrame([("A_20220201", "A", 5.0, 20220201)],
                                "pk string, symbol string, split_factor double, date int")
    mapping = {"PK": "pk", "Symbol": "symbol", "SplitFactor": "split_factor", "Date": "date"}
    plans, write = [], S._write

    def spy(st_, df):
        plans.append(df._jdf.queryExecution().executedPlan())
        return write(st_, df)

    monkeypatch.setattr(S, "_write", spy)
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # a plain plan tree to walk
    try:
        S.merge_into(spark, st, upd, ["PK"], mapping)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    leaves = plans[-1].collectLeaves()
    dest_filters = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "FileSourceScanExec" and leaf.tableIdentifier().isDefined():
            dest_filters.append(leaf.partitionFilters().toString())
    assert len(dest_filters) >= 2 and all("20220201" in f for f in dest_filters), dest_filters
    assert sorted(tuple(r) for r in S.read_staging(spark, st).collect()) == [
        ("A_20220101", "A", 1.0, 20220101), ("A_20220201", "A", 5.0, 20220201), ("A_20220301", "A", 3.0, 20220301)]


def test_fact_merge_with_no_dated_updates(spark):
    """No touched dates (empty updates, or NULL dates only): only the NULL partition is rewritten."""
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "nodates"),
                          spark.createDataFrame([("A_1", "A", 1.0, 20220101), (None, "N", 2.0, None)],
                                                "PK string, Symbol string, SplitFactor float, Date int"))
    mapping = {"PK": "pk", "Symbol": "symbol", "SplitFactor": "split_factor", "Date": "date"}
    schema = "pk string, symbol string, split_factor double, date int"
    S.merge_into(spark, st, spark.createDataFrame([], schema), ["PK"], mapping)
    assert sorted(map(tuple, S.read_staging(spark, st).collect()), key=repr) == \
        [("A_1", "A", 1.0, 20220101), (None, "N", 2.0, None)]
    S.merge_into(spark, st, spark.createDataFrame([(None, "M", 3.0, None)], schema), ["PK"], mapping)
    assert sorted(map(tuple, S.read_staging(spark, st).collect()), key=repr) == \
        [("A_1", "A", 1.0, 20220101), (None, "M", 3.0, None), (None, "N", 2.0, None)]


def test_dim_merge_versions(spark):
    st = S.create_staging(spark, "DimCurrency", shared_dir(spark, "t", "cur"),
                          spark.createDataFrame([("C1", "$", "one")], "CurrencyId string, Symbol string, Name string"))
    upd = spark.createDataFrame([("C1", "$", "uno"), ("C2", "E", "two")], "code string, symbol string, name string")
    S.merge_into(spark, st, upd, ["CurrencyId"], {"CurrencyId": "code", "Symbol": "symbol", "Name": "name"})
    assert sorted(tuple(r) for r in S.read_staging(spark, st).collect()) == [("C1", "$", "uno"), ("C2", "E", "two")]


CURRENCY = {"CurrencyId": "code", "Symbol": "symbol", "Name": "name"}
SPLITS = {"PK": "pk", "Symbol": "symbol", "SplitFactor": "split_factor", "Date": "date"}
SPLIT_ROWS = "PK string, Symbol string, SplitFactor float, Date int"
SPLIT_UPDATES = "pk string, symbol string, split_factor double, date int"


def _currencies(spark, *names):
    return spark.createDataFrame([(f"C{i}", "$", n) for i, n in enumerate(names)], "code string, symbol string, name string")


def test_frames_outlive_merges_until_retired(spark):
    """No merge removes a file: a frame resolved before four merges still reads; retiring is a call of its own."""
    from tidemark.session import list_dirs
    dim = S.create_staging(spark, "DimCurrency", shared_dir(spark, "t", "keep"))
    S.merge_into(spark, dim, _currencies(spark, "n0"), ["CurrencyId"], CURRENCY)
    fact = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "keepf"),
                            spark.createDataFrame([("A_1", "A", 1.0, 20220101)], SPLIT_ROWS))
    held, held_fact = S.read_staging(spark, dim), S.read_staging(spark, fact).where("Date = 20220101")
    held.count(), held_fact.count()
    for i in range(4):
        S.merge_into(spark, dim, _currencies(spark, f"m{i}", "x"), ["CurrencyId"], CURRENCY)
        S.merge_into(spark, fact, spark.createDataFrame([("A_1", "A", 5.0 + i, 20220101)], SPLIT_UPDATES), ["PK"], SPLITS)
    assert [r.Name for r in held.collect()] == ["n0"] and held_fact.count() == 1
    assert sorted(r.Name for r in S.read_staging(spark, dim).collect()) == ["m3", "x"]
    versions = [n for n in list_dirs(spark, dim.path) if n.startswith("v-")]
    assert len(versions) == 6 and S.retire(spark, dim, 3600) == []
    assert len(S.retire(spark, dim, 0)) == 5
    assert sorted(n.split("-")[0] for n in S.retire(spark, fact, 0)) == ["m"] * 4 + ["v"] * 4
    assert spark.sql(f"SHOW TABLES IN {fact.database}").where("tableName LIKE '%__v%'").count() == 1
    assert sorted(r.Name for r in S.read_staging(spark, dim).collect()) == ["m3", "x"]
    assert [r.SplitFactor for r in S.read_staging(spark, fact).collect()] == [8.0]


def test_merge_lost_before_the_switch_leaves_the_old_table(spark, monkeypatch):
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "lost"), spark.createDataFrame(
        [("A_1", "A", 1.0, 20220101), ("B_1", "B", 2.0, 20220101)], SPLIT_ROWS))
    updates = spark.createDataFrame([("A_1", "A", 9.0, 20220101), ("C_2", "C", 3.0, 20220201)], SPLIT_UPDATES)
    switch = S._switch
    monkeypatch.setattr(S, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError, match="driver lost"):
        S.merge_into(spark, st, updates, ["PK"], SPLITS)
    assert sorted(r.SplitFactor for r in S.read_staging(spark, st).collect()) == [1.0, 2.0]
    monkeypatch.setattr(S, "_switch", switch)
    S.merge_into(spark, st, updates, ["PK"], SPLITS)
    assert sorted(r.SplitFactor for r in S.read_staging(spark, st).collect()) == [2.0, 3.0, 9.0]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_tables_come_back_from_storage(spark):
    rows = spark.createDataFrame([("A_1", "A", 1.0, 20220101), ("B_1", "B", 2.0, 20220201), (None, "N", 3.0, None)], SPLIT_ROWS)
    fact = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "back"), rows)
    dim = S.create_staging(spark, "DimCurrency", shared_dir(spark, "t", "backd"))
    S.merge_into(spark, fact, spark.createDataFrame([("A_1", "A", 9.0, 20220101)], SPLIT_UPDATES), ["PK"], SPLITS)
    S.merge_into(spark, dim, _currencies(spark, "n"), ["CurrencyId"], CURRENCY)
    before = [_rows(S.read_staging(spark, st)) for st in (fact, dim)]
    for st in (fact, dim):
        spark.sql(f"DROP DATABASE {st.database} CASCADE")
        with pytest.raises(S.LostTableError, match="recreate"):
            S.read_staging(spark, st)
        with pytest.raises(S.LostTableError):
            S.merge_into(spark, st, spark.createDataFrame([], SPLIT_UPDATES) if st is fact else _currencies(spark), ["PK"],
                         SPLITS if st is fact else CURRENCY)
        S.recreate(spark, st.table, st.path)
    assert [_rows(S.read_staging(spark, st)) for st in (fact, dim)] == before
    S.merge_into(spark, fact, spark.createDataFrame([("C_1", "C", 4.0, 20220201)], SPLIT_UPDATES), ["PK"], SPLITS)
    assert S.read_staging(spark, fact).count() == 4
    empty = S.staging_table("FactSplits", shared_dir(spark, "t", "none"))
    assert S.read_staging(spark, empty).count() == 0 and S.recreate(spark, empty.table, empty.path) == empty


def test_two_merges_from_one_version_conflict(spark, monkeypatch):
    st = S.create_staging(spark, "DimCurrency", shared_dir(spark, "t", "conflict"))
    S.merge_into(spark, st, _currencies(spark, "a"), ["CurrencyId"], CURRENCY)
    write = S._write

    def slow(st_, df):
        monkeypatch.setattr(S, "_write", write)
        S.merge_into(spark, st, _currencies(spark, "first"), ["CurrencyId"], CURRENCY)
        return write(st_, df)

    monkeypatch.setattr(S, "_write", slow)
    with pytest.raises(S.ConcurrentMergeError):
        S.merge_into(spark, st, _currencies(spark, "second"), ["CurrencyId"], CURRENCY)
    assert [r.Name for r in S.read_staging(spark, st).collect()] == ["first"]


def test_a_reload_of_many_dates_is_one_step(spark, monkeypatch):
    """2,000 dates: as many statements as for two; a reader sees none of them, then all."""
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "many"),
                          spark.createDataFrame([("A", "A", 1.0, 20220101), ("B", "B", 1.0, 20220102)], SPLIT_ROWS))
    days = spark.range(2000).select(F.date_format(F.date_add(F.lit("2018-01-01").cast("date"), F.col("id").cast("int")), "yyyyMMdd").cast("int").alias("date"))
    updates = days.select(F.concat(F.lit("K_"), "date").alias("pk"), F.lit("K").alias("symbol"), F.lit(2.0).alias("split_factor"), "date").coalesce(2)
    seen, sql = [], type(spark).sql

    def spy(self, text, *a, **k):
        if not text.startswith(("SHOW", "DESCRIBE")):
            seen.append((text.split("(")[0].split(" AS ")[0][:40], sql(self, f"SELECT count(*) FROM {st.name}").first()[0]))
        return sql(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", spy)
    S.merge_into(spark, st, updates, ["PK"], SPLITS)
    monkeypatch.undo()
    assert len(seen) == 5 and {n for _, n in seen} == {2}  # database, old table, table, partitions, view
    assert S.read_staging(spark, st).count() == 2002
    assert S.read_staging(spark, st).where("Date = 20220102").count() == 2


def test_marks_follow_merges(spark):
    """Rows and latest date by symbol equal the whole aggregate after merges that add, move and drop dates."""
    from tidemark.operators.incremental import max_date_per_symbol
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "marks"), spark.createDataFrame(
        [("a1", "A", 1.0, 20220101), ("a2", "A", 2.0, 20220301), ("b1", "B", 1.0, 20220201), ("c1", "C", 1.0, None), ("d1", "D", 1.0, 20220301)],
        SPLIT_ROWS))
    by_key = {"PK": "pk", "Symbol": "symbol", "SplitFactor": "split_factor", "Date": "date"}
    merges = [[("a2", "A", 2.0, 20220115)], [("b1", "E", 1.0, 20220201)], [("d1", "D", 1.0, None)], [("c1", "C", 1.0, 20220401)],
              [("n1", "N", 1.0, 20230101), (None, None, 1.0, 20230101)], [("n1", "A", 1.0, 20230101)], []]
    for rows in merges:
        S.merge_into(spark, st, spark.createDataFrame(rows, SPLIT_UPDATES), ["PK"], by_key)
        facts = S.read_staging(spark, st)
        expected = facts.groupBy("Symbol").agg(F.count("*").alias("n"), F.max("Date"))
        assert _rows(S.read_marks(spark, st)) == _rows(expected)
        assert _rows(S.read_marks(spark, st).select("Symbol", "max_date")) == _rows(max_date_per_symbol(facts))


def test_views_follow_merges(spark):
    from tidemark.plans.views import create_analytics_views
    root = shared_dir(spark, "t", "views")
    db = "t_views_" + root[-8:]
    st = S.create_staging(spark, "FactSplits", f"{root}/s", spark.createDataFrame([("A_1", "A", 1.0, 20220101)], SPLIT_ROWS), db)
    assert create_analytics_views(spark, db, f"{db}_a", f"{root}/a") == [f"{db}_a.vw_FactSplits"]
    view = spark.table(f"{db}_a.vw_FactSplits")
    for i in range(2):
        S.merge_into(spark, st, spark.createDataFrame([("A_1", "A", 4.0 + i, 20220101), (f"B_{i}", "B", 1.0, 20220301 + i)],
                                                      SPLIT_UPDATES), ["PK"], SPLITS)
    assert sorted(r.SplitFactor for r in spark.table(f"{db}_a.vw_FactSplits").collect()) == [1.0, 1.0, 5.0]
    assert view.count() >= 1


def test_merge_reports_values_that_do_not_cast(spark):
    st = S.create_staging(spark, "FactDividends", shared_dir(spark, "t", "casts"))
    rows = [("A_1", "A", 1.0, "20220101"), ("B_x", "B", 2.0, "soon"), ("C_n", "C", 3.0, None)]
    updates = spark.createDataFrame(rows, "pk string, symbol string, dividend double, date string")
    mapping = {"PK": "pk", "Symbol": "symbol", "Dividend": "dividend", "Date": "date"}
    assert S.merge_into(spark, st, updates, ["PK"], mapping) == {"Date": 1}


def test_dates_of_matched_rows_are_looked_up_within_the_key_range(spark):
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "range"), spark.createDataFrame(
        [(f"K{i:03d}", "A", 1.0, 20220101 + i % 3) for i in range(200)], SPLIT_ROWS))
    dest = S.read_staging(spark, st)
    within = S._key_range(dest, spark.createDataFrame([("K100",), ("K102",), (None,)], "PK string"), ["PK"])
    plan = within._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(PK,K100)" in plan and "LessThanOrEqual(PK,K102)" in plan
    assert _rows(within.select("PK")) == [("K100",), ("K101",), ("K102",)]
    assert S._key_range(dest, spark.createDataFrame([(None,)], "PK string"), ["PK"]).count() == 0


def test_key_implies_the_date_only_as_landed(spark):
    assert S.key_implies_partition("FactSplits", ["PK"], {**SPLITS, "PK": "updates.pk"})
    assert not S.key_implies_partition("FactSplits", ["PK"], {**SPLITS, "PK": "symbol"})
    assert not S.key_implies_partition("FactSplits", ["PK"], {"PK": "pk"})
    assert not S.key_implies_partition("DimCurrency", ["CurrencyId"], CURRENCY)
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "bykey"))
    for day in (20220101, 20220201):  # a key without a date: the row moves, it isn't doubled
        S.merge_into(spark, st, spark.createDataFrame([("x", "A", 1.0, day)], SPLIT_UPDATES), ["PK"], {**SPLITS, "PK": "symbol"})
    assert [(r.PK, r.Date) for r in S.read_staging(spark, st).collect()] == [("A", 20220201)]


def test_mapping_without_the_partition_keeps_dates(spark):
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "nodate"),
                          spark.createDataFrame([("A_1", "A", 1.0, 20220101), ("B_1", "B", 2.0, 20220201)], SPLIT_ROWS))
    updates = spark.createDataFrame([("A_1", "A", 9.0, 5), ("N", "N", 3.0, 6)], SPLIT_UPDATES)
    S.merge_into(spark, st, updates, ["PK"], {"PK": "pk", "SplitFactor": "split_factor"})
    assert sorted((r.PK, r.SplitFactor, r.Date or 0) for r in S.read_staging(spark, st).collect()) == [
        ("A_1", 9.0, 20220101), ("B_1", 2.0, 20220201), ("N", 3.0, 0)]


def test_reload_after_an_incremental_merge_changes_nothing(spark):
    """Two rows of one key in one run: both modes keep the same one."""
    from tidemark.plans import loader as LD
    root = shared_dir(spark, "t", "ties")
    lake = LD.Lake(spark, root, f"tl_{root[-8:]}", f"ts_{root[-8:]}", f"ta_{root[-8:]}")
    rows = spark.createDataFrame([("20220101", 1.0, "A", "A_20220101"), ("20220101", 2.0, "A", "A_20220101")],
                                 "date string, dividend float, symbol string, pk string")
    lt = lake.landing("FactDividends")
    L.append_run(rows, lt, 20220701, 1)
    L.register_run(spark, lt, 20220701, 1)
    seen = []
    for full in (False, True, False):
        LD.merge_landed(spark, lake, "FactDividends", {"is_full_reload": full})
        seen.append([tuple(r) for r in lake.read_staging("FactDividends").collect()])
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 1


def test_retry_of_a_lost_registration_replaces_the_run(spark, monkeypatch):
    from tidemark.plans.loader import land_pages
    lt = L.create_landing(spark, "t_retry", "DimCurrency", shared_dir(spark, "t", "retry"))
    pages = P.build_pages(_currencies(spark, "a", "b"), F.struct("code", "symbol", "name"))
    register = L.register_run
    monkeypatch.setattr(L, "register_run", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        land_pages(spark, lt, pages, "currencies", 20220701, attempt="job 1")
    monkeypatch.setattr(L, "register_run", register)
    assert land_pages(spark, lt, pages, "currencies", 20220701, attempt="job 1") == 1
    assert L.read_landing(spark, lt).count() == 2
    assert land_pages(spark, lt, pages, "currencies", 20220701, attempt="job 2") == 2
    assert L.read_landing(spark, lt).count() == 4


def _land(spark, lt, *names, day=20220701):
    from tidemark.plans.loader import land_pages
    return land_pages(spark, lt, P.build_pages(_currencies(spark, *names), F.struct("code", "symbol", "name")), "currencies", day)


def _landed_names(spark, lt):
    L.repair(spark, lt)
    spark.catalog.refreshTable(lt.name)
    return sorted(r.name for r in L.read_landing(spark, lt).collect())


def test_a_catalog_without_partitions_costs_no_run(spark):
    path = shared_dir(spark, "t", "lostcat")
    lt = L.create_landing(spark, "t_lostcat", "DimCurrency", path)
    assert _land(spark, lt, "a") == 1
    spark.sql(f"DROP TABLE {lt.name}")
    lt = L.create_landing(spark, "t_lostcat", "DimCurrency", path)
    assert _land(spark, lt, "b") == 2 and _landed_names(spark, lt) == ["a", "b"]


def test_two_loaders_never_share_a_run(spark):
    from concurrent.futures import ThreadPoolExecutor
    lt = L.create_landing(spark, "t_two", "DimCurrency", shared_dir(spark, "t", "two"))
    names = [f"n{i}" for i in range(8)]
    with ThreadPoolExecutor(8) as pool:
        runs = list(pool.map(lambda n: _land(spark, lt, n), names))
        claims = list(pool.map(lambda i: L.claim_run(spark, lt, 20220702, f"a{i}"), range(40)))
    assert sorted(runs) == list(range(1, 9)) and _landed_names(spark, lt) == names
    assert sorted(claims) == list(range(1, 41)) and L.claim_run(spark, lt, 20220702, "a7") == claims[7]


def test_no_attempt_writes_the_run_of_another(spark):
    lt = L.create_landing(spark, "t_taken", "DimCurrency", shared_dir(spark, "t", "taken"))
    rows = _currencies(spark, "a")
    assert L.append_run(rows, lt, 20220701, 3, "mine") == 1 and L.append_run(rows, lt, 20220701, 3, "mine") == 1
    with pytest.raises(L.RunTakenError):
        L.append_run(rows, lt, 20220701, 3, "other")
    L.append_runs(rows.selectExpr("*", "20220701 AS dayId", "4 AS runId"), lt)  # a run of a writer without claims
    with pytest.raises(L.RunTakenError):
        L.append_run(rows, lt, 20220701, 4)
    assert _land(spark, lt, "b") == 5 and _landed_names(spark, lt) == ["a", "a", "b"]


def test_discovery_lists_days_from_the_latest_on(spark, monkeypatch):
    lt = L.create_landing(spark, "t_found", "DimCurrency", shared_dir(spark, "t", "found"))

    def write(day, run, name):
        L.append_runs(_currencies(spark, name).selectExpr("*", f"{day} AS dayId", f"{run} AS runId"), lt)

    for day, run in ((20220701, 1), (20220702, 1), (20220703, 2)):
        write(day, run, f"d{day}")
    assert L.discover(spark, lt) == [(20220701, 1), (20220702, 1), (20220703, 2)]
    for day, run in ((20220703, 10), (20220704, 1), (20220701, 2)):
        write(day, run, f"n{day}")
    listed, list_dirs = [], L.list_dirs
    monkeypatch.setattr(L, "list_dirs", lambda s, path: listed.append(path.removeprefix(lt.path)) or list_dirs(s, path))
    assert L.discover(spark, lt) == [(20220703, 10), (20220704, 1)] and L.discover(spark, lt) == []
    assert listed == ["", "/dayId=20220703", "/dayId=20220704", "", "/dayId=20220704"]
    assert L.read_landing(spark, lt).count() == 5
    L.repair(spark, lt)  # a run under an earlier day
    assert L.read_landing(spark, lt).count() == 6


def test_one_failing_table_does_not_end_the_batch(spark):
    from tidemark.plans import loader as LD
    inbox, root = shared_dir(spark, "t", "batch"), shared_dir(spark, "t", "lakeb")
    lake = LD.Lake(spark, root, f"bl_{root[-8:]}", f"bs_{root[-8:]}", f"ba_{root[-8:]}")
    cfg = {"table_type": "Dim", "tables": [{"is_enabled": True, "table_name": t, "exchange": ""} for t in ("DimExchange", "DimCurrency")]
           + [{"is_enabled": False, "table_name": "DimCompany", "exchange": "X"}]}
    _fetched(spark, f"{inbox}/DimCurrency", [("currencies", 1, 0, _page(1, "A"))])
    _fetched(spark, f"{inbox}/DimExchange", [("exchanges", 1, 0, '{"error": "down"}')])
    outcomes = LD.load_batch(spark, cfg, LD.FilePageSource(spark, inbox), lake, "2022-07-03")
    assert [(o.table_name, o.status, o.run_id) for o in outcomes] == [("DimExchange", "failed", None), ("DimCurrency", "loaded", 1)]
    assert "down" in outcomes[0].error and lake.read_staging("DimCurrency").count() == 1
    assert LD.outcome_table(spark, outcomes).count() == 2
    with pytest.raises(LD.BatchError, match="DimExchange") as raised:
        LD.update_tables(spark, cfg, LD.FilePageSource(spark, inbox), lake, "2022-07-03")
    assert [o.status for o in raised.value.outcomes] == ["failed", "loaded"]


def test_a_loader_beside_the_stream_keeps_its_run(spark):
    from tidemark.streaming import stream_pages_to_landing
    inbox, ckpt = shared_dir(spark, "t", "inbox2"), shared_dir(spark, "t", "ckpt2")
    lt = L.create_landing(spark, "t_beside", "DimCurrency", shared_dir(spark, "t", "beside"))
    for name, run in (("s1", 1), ("s2", 3)):
        P.write_pages(P.build_pages(_currencies(spark, name), F.struct("code", "symbol", "name")).coalesce(1), inbox)
        stream_pages_to_landing(spark, inbox, "currencies", lt, 20220701, ckpt).awaitTermination()
        assert L.latest_run(spark, lt) == (20220701, run)
        if run == 1:
            assert _land(spark, lt, "loader") == 2
    assert _landed_names(spark, lt) == ["loader", "s1", "s2"]


def test_error_pages_and_missing_totals_fail_with_their_text(spark):
    def page(text):
        return P.parse_pages(spark.createDataFrame([(text,)], "page string"), "currencies")

    with pytest.raises(Exception, match="rate_limit"):
        P.explode_pages(page('{"error": {"code": "rate_limit"}}')).collect()
    with pytest.raises(Exception, match="without a total.*code"):
        P.page_totals(page('{"data": [{"code": "X"}]}')).collect()


def _fetched(spark, path, rows):
    for fetched_at in sorted({r[1] for r in rows}):
        P.land_fetched(spark.createDataFrame([(r[0], r[2], r[3]) for r in rows if r[1] == fetched_at], P.FETCHED), path, fetched_at)


def _page(total, *codes):
    import json
    return json.dumps({"pagination": {"total": total}, "data": [{"code": c, "symbol": "$", "name": c} for c in codes]})


def test_file_pages_answer_their_requests_completely(spark):
    from tidemark.plans import loader as LD
    inbox, root = shared_dir(spark, "t", "fetched"), shared_dir(spark, "t", "lake")
    lake = LD.Lake(spark, root, f"fl_{root[-8:]}", f"fs_{root[-8:]}", f"fa_{root[-8:]}")
    cfg = {"table_type": "Dim", "tables": [{"is_enabled": True, "table_name": "DimCurrency", "exchange": ""}]}
    source = LD.FilePageSource(spark, inbox)
    many = [f"A{i}" for i in range(1000)]
    _fetched(spark, f"{inbox}/DimCurrency", [("currencies", 1, 0, _page(1001, *many)), ("other", 9, 0, _page(1, "ZZ"))])
    with pytest.raises(Exception, match="1000 of 1001 records, page at offset 1000"):
        LD.update_tables(spark, cfg, source, lake, "2022-07-03")
    assert L.partitions(spark, lake.landing("DimCurrency")).count() == 0
    _fetched(spark, f"{inbox}/DimCurrency", [("currencies", 1, 1000, _page(1001, "B"))])
    assert list(LD.update_tables(spark, cfg, source, lake, "2022-07-03").values()) == [1]
    assert lake.read_staging("DimCurrency").count() == 1001
    _fetched(spark, f"{inbox}/DimCurrency", [("currencies", 2, 0, _page(1, "C"))] * 2)  # a later fetch, landed twice
    LD.update_tables(spark, cfg, source, lake, "2022-07-03")
    assert L.latest_run_rows(spark, lake.landing("DimCurrency")).count() == 1
    assert lake.read_staging("DimCurrency").count() == 1002
    _fetched(spark, f"{inbox}/none/DimCurrency", [("another request", 1, 0, _page(1, "X"))])
    with pytest.raises(Exception, match="incomplete response to currencies: 0 of 0"):
        LD.update_tables(spark, cfg, LD.FilePageSource(spark, f"{inbox}/none"), lake, "2022-07-03")


def test_only_folders_of_the_requests_are_read(spark):
    """Twenty older fetches and other requests: the scan lists the newest fetch alone and prunes it to the buckets."""
    path = shared_dir(spark, "t", "store")
    _fetched(spark, path, [(f"r{i}", t, 0, f"{t}-{i}") for t in range(1, 21) for i in range(40)] + [("r3", 21, 0, "new"), ("r3", 21, 1000, "newer")])
    requests = spark.createDataFrame([("r3",), ("unknown",)], "path string")
    found = P.answers(spark, path, requests).checkpoint()
    assert [tuple(r) for r in found.collect()] == [("r3", 21)]
    pages = P.fetched_pages(spark, path, found)
    assert _rows(pages.select("offset", "page")) == [(0, "new"), (1000, "newer")]
    assert {f.split("fetched_at=")[1].split("/")[0] for f in pages.inputFiles()} == {"21"}
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and re.search(r"PartitionFilters: \[[^]]*bucket#", plan)
    older = P.fetched_pages(spark, path, P.answers(spark, path, spark.createDataFrame([("r5",), ("r6",)], "path string")).checkpoint())
    assert _rows(older.select("request", "page")) == [("r5", "20-5"), ("r6", "20-6")]


def test_bad_pages_fail_the_load_or_go_to_quarantine(spark):
    from tidemark.plans.loader import land_pages
    lt = L.create_landing(spark, "t_bad", "DimCurrency", shared_dir(spark, "t", "bad"))
    rows = [("a", 0, _page(1, "A")), ("b", 0, '{"error": {"code": "rate_limit"}}'), ("c", 0, '{"data": [{"code": "C"}]}'),
            ("d", 0, None), ("e", 0, _page(0)), ("a", 0, _page(1, "A"))]
    pages = spark.createDataFrame(rows, P.FETCHED)
    requests = spark.createDataFrame([(r,) for r in "abcde"], "path string")
    with pytest.raises(P.ErrorPageError, match="in answer to [bcd]"):
        land_pages(spark, lt, pages, "currencies", 20220701, requests)
    assert L.partitions(spark, lt).count() == 0
    kept = shared_dir(spark, "t", "quarantine")
    assert land_pages(spark, lt, pages, "currencies", 20220701, requests, quarantine=kept) == 1
    assert [r.code for r in L.latest_run_rows(spark, lt).collect()] == ["A"]
    bad = spark.read.schema(P.FETCHED + ", dayId INT, runId INT").json(kept)
    assert _rows(bad.select("request", "dayId", "runId")) == [("b", 20220701, 1), ("c", 20220701, 1), ("d", 20220701, 1)]
    assert bad.where("page LIKE '%rate_limit%'").count() == 1
    with pytest.raises(Exception, match="incomplete response to zz"):  # a request without any page isn't excused
        land_pages(spark, lt, pages, "currencies", 20220701, spark.createDataFrame([("a",), ("zz",)], "path string"), quarantine=kept)


def test_high_water_marks_cut_the_fact_first(spark):
    """The fact is semi-joined to the groups' companies below its aggregate."""
    from tidemark.operators.incremental import exchange_groups, high_water_marks
    dim = spark.createDataFrame([("P1", "A", "n", "X1")], "PK string, CompanyId string, CompanyName string, ExchangeId string")
    fact = spark.createDataFrame([("A", 20220105), ("B", 20220301)], "Symbol string, Date int")
    marks = high_water_marks(exchange_groups(spark, {"g": "X1"}), dim, fact, "2010-01-01")
    plan = marks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("max(Date") < plan.index("LeftSemi")
    assert [tuple(r) for r in marks.collect()] == [("g", "2022-01-05")]


def test_no_local_folder_is_invented_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from tidemark.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *a: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_index_with_many_ranges_runs_nothing_while_planned(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, "ALL").otherwise((F.col("id") % 20).cast("string")).alias("g"),
                                    ((F.col("id") * 7919) % 60_000).alias("k"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    ranked = chunk_within(df, ["g"], ["k"], 99)
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setJobGroup("running", "running")
    indexed = with_global_index(df, ["k"], "idx", num_ranges=2000)
    assert indexed.where("k <> idx").count() == 0 and ranked.groupBy("g", "chunk_no").count().where("count > 99").count() == 0


def test_high_water_mark_branches(spark):
    from tidemark.operators.incremental import exchange_groups, high_water_marks
    dim = spark.createDataFrame([("P1", "A", "n", "X1"), ("P2", "B", "n", "X1"), ("P3", "A", "n", "X2"),
                                 ("P4", "C", "n", "X3")],
                                "PK string, CompanyId string, CompanyName string, ExchangeId string")
    fact = spark.createDataFrame([("A", 20220105), ("A", 20220301), ("B", 20220210)], "Symbol string, Date int")
    groups = exchange_groups(spark, {"g1": "'X1', 'X2'", "g2": "X3", "g3": "XNONE"})
    got = {r.group_id: r.date_from for r in high_water_marks(groups, dim, fact, "2010-01-01").collect()}
    assert got == {"g1": "2022-02-10", "g2": "2010-01-01", "g3": "2010-01-01"}


def test_merge_key_parsing():
    from tidemark.plans.loader import merge_key_columns
    assert merge_key_columns("destination.PK = updates.pk") == ["PK"]
    assert merge_key_columns("destination.`Date` = updates.`Date` AND destination.X = updates.x") == ["Date", "X"]


def test_staging_merge_duplicate_match_fails_without_writing(spark):
    st = S.create_staging(spark, "FactSplits", shared_dir(spark, "t", "dup"),
                          spark.createDataFrame([("A_20220101", "A", 1.0, 20220101)],
                                                "PK string, Symbol string, SplitFactor float, Date int"))
    upd = spark.createDataFrame([("A_20220101", "A", 2.0, 20220101), ("A_20220101", "A", 3.0, 20220101)],
                                "pk string, symbol string, split_factor double, date int")
    mapping = {"PK": "pk", "Symbol": "symbol", "SplitFactor": "split_factor", "Date": "date"}
    with pytest.raises(Exception, match="matched by several update rows"):
        S.merge_into(spark, st, upd, ["PK"], mapping)
    assert [tuple(r) for r in S.read_staging(spark, st).collect()] == [("A_20220101", "A", 1.0, 20220101)]


def test_stream_lands_each_batch_as_a_run(spark):
    from tidemark.streaming import stream_pages_to_landing
    rec = spark.range(3000).select(F.format_string("C%d", "id").alias("code"), F.lit("$").alias("symbol"),
                                   F.lit("n").alias("name"))
    inbox = shared_dir(spark, "t", "inbox")
    for part in range(3):  # three responses arrive as three files
        chunk = rec.where(F.col("code").substr(2, 10).cast("int") % 3 == part)
        P.write_pages(P.build_pages(chunk, F.struct("code", "symbol", "name")).coalesce(1), inbox)
    lt = L.create_landing(spark, "t_stream", "DimCurrency", shared_dir(spark, "t", "stream"))
    ckpt = shared_dir(spark, "t", "ckpt")
    q = stream_pages_to_landing(spark, inbox, "currencies", lt, 20220701, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    runs = L.partitions(spark, lt).count()
    assert runs == 3
    assert L.read_landing(spark, lt).count() == 3000
    # restarting on the same checkpoint finds nothing new and lands nothing twice; nor does a batch whose commit
    # record was lost, which is replayed into its own run, whatever day it is by then
    import os
    for name in ("2", ".2.crc"):
        os.remove(f"{ckpt.removeprefix('file:')}/commits/{name}")
    q2 = stream_pages_to_landing(spark, inbox, "currencies", lt, 20220702, ckpt, max_files_per_trigger=1)
    q2.awaitTermination()
    assert L.read_landing(spark, lt).count() == 3000
    assert sorted(tuple(r) for r in L.partitions(spark, lt).collect()) == [(20220701, i) for i in (1, 2, 3)]
