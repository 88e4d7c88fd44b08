"""Property checks against plain-Python models on random small inputs,
and the pipeline check of layer 4: consecutive runs, the last one empty."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe_runs
from tidemark.operators.indexing import with_global_index
from tidemark.operators.upsert import merge_frames
from tidemark.sinks import landing as L

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"]))


@SETTINGS
@given(dest=st.lists(st.tuples(KEYS, st.integers(0, 99)), max_size=8),
       upd=st.lists(st.tuples(KEYS, st.integers(100, 199)), max_size=8))
def test_merge_matches_model(spark, dest, upd):
    # at most one update row per non-NULL key, so no destination row is matched twice
    seen, unique_upd = set(), []
    for k, v in upd:
        if k is None or k not in seen:
            unique_upd.append((k, v))
            seen.add(k)
    d = spark.createDataFrame(dest, "K string, V int")
    u = spark.createDataFrame(unique_upd, "k string, v int")
    got = sorted((tuple(r) for r in merge_frames(d, u, ["K"], {"K": "k", "V": "v"}).collect()), key=repr)
    upd_keys = {k for k, _ in unique_upd if k is not None}
    want = unique_upd + [(k, v) for k, v in dest if k is None or k not in upd_keys]
    assert got == sorted(want, key=repr)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(20220701, 20220703),
                               st.integers(1, 12), st.integers(0, 10**6)), max_size=12, unique_by=lambda t: t[3]))
def test_dedupe_keeps_one_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "pk string, dayId int, runId int, tie int")
    for recency, sort_key in (("reference", lambda t: (t[1], -t[2], t[3])),
                              ("latest", lambda t: (-t[1], -t[2], t[3]))):
        got = {r.pk: tuple(r) for r in dedupe_runs(df, "pk", recency, ["tie"]).collect()}
        want = {}
        for t in sorted(rows, key=sort_key):
            want.setdefault(t[0], t)
        assert got == want


@SETTINGS
@given(keys=st.lists(st.integers(-1000, 1000), unique=True, max_size=40))
def test_global_index_is_sorted_position(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = {r.k: r.idx for r in with_global_index(df, ["k"], "idx", num_ranges=4).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_pipeline_runs_then_empty_run(spark, sf_dir):
    """Dims, a fact run, an overlapping run, then an empty response."""
    from tidemark import fixtures as fx
    from tidemark.plans import loader as LD
    from tidemark.plans.queries import fact_config, load_dims, load_facts

    lake, source, exchanges = load_dims(spark, sf_dir)
    load_facts(spark, sf_dir, lake, source, exchanges, 1)
    after_first = sorted(tuple(r) for r in lake.read_staging("FactEod").collect())
    load_facts(spark, sf_dir, lake, source, exchanges, 2)
    after_second = sorted(tuple(r) for r in lake.read_staging("FactEod").collect())
    assert after_first and after_second == after_first     # the overlap re-reads and upserts the same rows

    class EmptyApi:
        """Every request is answered with a page holding no records."""
        def fetch(self, table, endpoint, requests):
            return requests.select(F.col("path").alias("request"), F.lit(0).cast("long").alias("offset"),
                                   F.lit('{"pagination": {"total": 0}, "data": []}').alias("page"))

    LD.update_tables(spark, fact_config(exchanges), EmptyApi(), lake, fx.NOW)
    runs = sorted(tuple(r) for r in L.partitions(spark, lake.landing("FactEod")).collect())
    assert runs == [(LD.run_day(fx.NOW), 1), (LD.run_day(fx.NOW), 2)]
    assert sorted(tuple(r) for r in lake.read_staging("FactEod").collect()) == after_first


def test_file_page_source_dimension_load(spark):
    """Pages a fetcher landed as JSON-lines files feed a dimension load; a second
    response upserts by key (changed name, new currency, unchanged one kept)."""
    from tidemark.plans import loader as LD
    from tidemark.session import shared_dir
    from tidemark.sources import pages as P

    lake = LD.Lake(spark, shared_dir(spark, "lake"), "t_file_pages_l", "t_file_pages_s", "t_file_pages_a")
    inbox = shared_dir(spark, "inbox")
    cfg = {"table_type": "Dim", "tables": [{"is_enabled": True, "table_name": "DimCurrency", "exchange": ""}]}

    def respond(rows, fetched_at):
        rec = spark.createDataFrame(rows, "code string, symbol string, name string").withColumn("path", F.lit("currencies"))
        pages = P.build_pages(rec, F.struct("code", "symbol", "name"), page_size=2, group=["path"], order=["code"])
        P.write_fetched(pages, f"{inbox}/DimCurrency", fetched_at, page_size=2)

    respond([("USD", "$", "Dollar"), ("EUR", "E", "Euro"), ("JPY", "Y", "Yen")], 1)
    LD.update_tables(spark, cfg, LD.FilePageSource(spark, inbox), lake, "2022-07-03")
    respond([("EUR", "E", "Euro (new)"), ("GBP", "P", "Pound")], 2)
    LD.update_tables(spark, cfg, LD.FilePageSource(spark, inbox), lake, "2022-07-03")
    got = sorted(tuple(r) for r in lake.read_staging("DimCurrency").collect())
    assert got == [("EUR", "E", "Euro (new)"), ("GBP", "P", "Pound"), ("JPY", "Y", "Yen"),
                   ("USD", "$", "Dollar")]
    runs = sorted(tuple(r) for r in L.partitions(spark, lake.landing("DimCurrency")).collect())
    assert runs == [(20220703, 1), (20220703, 2)]
