"""Page building on large tables: no shuffle or sort of records that the pages don't need."""

from __future__ import annotations

import json
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.operators.dedupe import dedupe_newest
from tidemark.session import list_files, shared_dir
from tidemark.sources import pages as P


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def records(spark, n=5003):
    text = F.when(F.col("id") % 7 != 0, F.concat(F.lit("a,\"b"), F.col("id").cast("string")))
    return spark.range(0, n, numPartitions=3).select("id", (F.col("id") % 3).alias("g"), text.alias("s"))


def test_unordered_pages_are_cut_without_a_shuffle_of_records(spark):
    rows = records(spark)
    pages = P.build_pages(rows, F.struct("id", "s"))
    assert "collect_list" not in plan_of(pages) and "page_no" not in "".join(
        line for line in plan_of(pages).splitlines() if "Exchange" in line)
    found = [json.loads(r.page) for r in pages.collect()]
    assert all(len(p["data"]) <= 1000 and p["pagination"] == {"total": 5003} for p in found)
    expected = [{"id": r.id} if r.s is None else {"id": r.id, "s": r.s} for r in rows.collect()]
    assert sorted((r for p in found for r in p["data"]), key=lambda r: r["id"]) == expected


@pytest.mark.parametrize("group", [[], ["g"]])
def test_ordered_pages_hold_consecutive_records(spark, group):
    by = defaultdict(list)
    for r in P.build_pages(records(spark), F.struct("id"), group=group, order=["id"]).collect():
        page = json.loads(r.page)
        by[r.g if group else 0].append((r.page_no, page["pagination"]["total"], [x["id"] for x in page["data"]]))
    for g, pages in by.items():
        ids = [i for i in range(5003) if not group or i % 3 == g]
        assert sorted(pages) == [(k, len(ids), ids[k * 1000:k * 1000 + 1000]) for k in range(-(-len(ids) // 1000))]


def test_ordered_pages_shuffle_texts_of_runs_of_records(spark):
    plan = plan_of(P.build_pages(records(spark), F.struct("id", "s"), order=["id"]))
    assert "MapInArrow" in plan and "collect_list(struct(__first" in plan.replace("named_", "").replace(" ", "")


def test_no_records_no_page(spark):
    assert P.build_pages(records(spark).where("id < 0"), F.struct("id"), order=["id"]).count() == 0
    assert P.build_pages(records(spark).where("id < 0"), F.struct("id")).count() == 0


def test_page_files_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(P, "PAGES_PER_FILE", 2)
    path = shared_dir(spark, "pages")
    P.write_pages(P.build_pages(records(spark).coalesce(1), F.struct(F.col("s").alias("code"))), path)
    files = [n for n in list_files(spark, path) if n.startswith("part-")]
    assert len(files) == 3 and all(n.endswith(".gz") for n in files)
    assert P.explode_pages(P.read_pages(spark, path, "currencies")).count() == 5003


def test_answers_are_landed_from_one_read_of_the_current_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(f"C{i}", f"X{i % 3}") for i in range(12)], "code STRING, symbol STRING").withColumn("name", F.lit("n"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(fx, "current_state", lambda *_: rows.mapInArrow(counted, rows.schema))
    root, requests = shared_dir(spark, "inbox"), spark.createDataFrame([("currencies",), ("none",)], "path STRING")
    fx.land_answers(spark, "", "DimCurrency", "currencies", requests, root)
    assert read.value == 12
    found = P.fetched_pages(spark, f"{root}/DimCurrency", P.answers(spark, f"{root}/DimCurrency", requests))
    held = {r.request: [x["code"] for x in json.loads(r.page)["data"]] for r in found.collect()}
    assert held == {"currencies": sorted(f"C{i}" for i in range(12)), "none": []}


def test_rows_with_null_keys_can_be_left_out_of_the_newest_rows(spark):
    rows = spark.createDataFrame([("a", 1, 1, 0), ("a", 1, 2, 1), (None, 9, 9, 2), ("b", 2, 1, 3)],
                                 "k STRING, dayId INT, runId INT, v INT")
    found = dedupe_newest(rows, "k", ["v"], drop_null_keys=True)
    assert sorted((r.k, r.v) for r in found.collect()) == [("a", 1), ("b", 3)]
    assert sorted((r.k or "", r.v) for r in dedupe_newest(rows, "k", ["v"]).collect()) == [("", 2), ("a", 1), ("b", 3)]
