"""How runs are written to landing tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.plans import loader as LD
from tidemark.session import shared_dir
from tidemark.sinks import landing as L
from tidemark.sources import pages as P


def test_a_run_of_even_tasks_is_written_without_a_shuffle(spark, monkeypatch):
    hints = []
    frame = type(spark.range(1))
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *a: hints.append(name) or hint(self, name, *a))
    lt = L.create_landing(spark, "scale_r03", "DimCurrency", shared_dir(spark, "landing"))
    rows = spark.createDataFrame([("A", "$", "x")], "code STRING, symbol STRING, name STRING")
    assert L.append_run(rows, lt, 20220703, 1, spread=False) == 1 and not hints
    assert L.append_run(rows, lt, 20220703, 2) == 1 and hints == ["rebalance"]


def currencies(spark, n, tasks=2):
    """Rows of four runs, ``n`` in all."""
    return spark.range(0, n, numPartitions=tasks).selectExpr("concat('C', id) AS code", "'$' AS symbol", "if(id % 3 = 0, NULL, 'x') AS name",
                                                             "20220701 + int(id % 2) AS dayId", "1 + int(id % 4 >= 2) AS runId")


def pages_of(spark, tmp_path, *texts):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "a.json").write_text("".join(t + "\n" for t in texts))
    return P.read_pages(spark, str(tmp_path / "pages"), "currencies").select("page")


def hints_of(spark, monkeypatch):
    hints, frame = [], type(spark.range(1))
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *a: hints.append(name) or hint(self, name, *a))
    return hints


@pytest.mark.parametrize("per_file, runs, most, hinted", [(100, 4, 400, []), (101, 4, 400, ["rebalance"]), (100, 3, 400, ["rebalance"]),
                                                          (100, 4, 399, ["rebalance"])])
def test_tasks_that_hold_much_of_each_run_write_it_without_a_shuffle(spark, monkeypatch, per_file, runs, most, hinted):
    monkeypatch.setattr(L, "ROWS_PER_FILE", per_file)
    monkeypatch.setattr(L, "RUNS_PER_TASK", runs)
    monkeypatch.setattr(L, "ROWS_PER_TASK", most)
    hints, rows = hints_of(spark, monkeypatch), currencies(spark, 800)
    at = shared_dir(spark, "landing")
    lt = L.create_landing(spark, f"scale_r04_{at[-8:]}", "DimCurrency", at)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    L.append_runs(rows, lt)
    L.repair(spark, lt)
    assert hints == hinted and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before
    landed = L.read_landing(spark, lt)
    assert sorted(map(tuple, landed.fillna("").collect())) == sorted(map(tuple, rows.fillna("").collect()))


def test_small_and_empty_frames_are_rebalanced_by_run(spark, monkeypatch):
    hints = hints_of(spark, monkeypatch)
    lt = L.create_landing(spark, "scale_r04_small", "DimCurrency", shared_dir(spark, "landing"))
    L.append_runs(currencies(spark, 8), lt)
    L.append_runs(currencies(spark, 0), lt)
    L.repair(spark, lt)
    assert hints == ["rebalance"] * 2 and L.read_landing(spark, lt).count() == 8


def test_pages_without_requests_are_landed_by_one_write(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(LD, "stage_pages", lambda *_: pytest.fail("the records were written twice"))
    pages = pages_of(spark, tmp_path, '{"pagination": {"total": 3}, "data": [{"code": "A", "name": "a"}, null]}',
                     '{"pagination": {"total": 3}, "data": [{"code": "B"}]}', '{"pagination": {"total": 0}, "data": []}')
    lt = L.create_landing(spark, "scale_r04_pages", "DimCurrency", shared_dir(spark, "landing"))
    assert [LD.land_pages(spark, lt, pages, "currencies", 20220703) for _ in range(2)] == [1, 2]
    found = sorted(map(tuple, L.read_landing(spark, lt).fillna("").collect()))
    assert found == sorted((c, "", n, 20220703, r) for c, n in (("A", "a"), ("B", ""), ("", "")) for r in (1, 2))


@pytest.mark.parametrize("bad", ['{"error": {"code": "rate_limit"}}', '{"data": [{"code": "rate_limit"}]}', "rate_limit"])
def test_a_bad_page_without_a_request_lands_nothing_and_keeps_what_the_attempt_landed(spark, tmp_path, bad):
    at = shared_dir(spark, "landing")
    lt = L.create_landing(spark, f"scale_r04_{at[-8:]}", "DimCurrency", at)
    good = '{"pagination": {"total": 1}, "data": [{"code": "A"}]}'
    pages = pages_of(spark, tmp_path, good, bad)
    with pytest.raises(P.ErrorPageError, match="rate_limit"):
        LD.land_pages(spark, lt, pages, "currencies", 20220703, attempt="job")
    L.repair(spark, lt)
    assert L.partitions(spark, lt).count() == 0 and L.next_run_id(spark, lt, 20220703) == 1
    assert LD.land_pages(spark, lt, pages.where(F.col("page") == good), "currencies", 20220703, attempt="job") == 1
    with pytest.raises(P.ErrorPageError, match="rate_limit"):
        LD.land_pages(spark, lt, pages, "currencies", 20220703, attempt="job")
    assert [r.code for r in L.latest_run_rows(spark, lt).collect()] == ["A"]
