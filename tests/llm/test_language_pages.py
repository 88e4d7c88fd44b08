"""The scorer of pages reads extracted texts; no extraction runs beside it."""

from __future__ import annotations

from tidemark.llm import language_id, queries
from tidemark.session import shared_dir


def test_texts_of_pages_are_extracted_before_they_are_scored(spark, monkeypatch):
    monkeypatch.setattr(language_id, "identify", lambda records: records)
    root = shared_dir(spark, "pages")
    spark.createDataFrame([(1, "http://a.de/x", "<html lang=de><article><p>Ein Text</p></article>"), (2, None, None)],
                          "page_id LONG, url STRING, html STRING").write.parquet(f"{root}/pages.parquet")
    scored = queries.language_id_pages(spark, root)
    rows = {r["page_id"]: r for r in scored.collect()}
    assert rows[1]["text"] == "Ein Text" and rows[1]["declared"] == "de" and rows[2]["text"] == ""
    assert "EvalPython" not in scored._jdf.queryExecution().executedPlan().toString()
