"""The flagship slice: land every eod run, full-reload upsert, analytics view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import loader as LD
from tidemark.plans.queries import landing_rows, widen
from tidemark.session import pin_utc, shared_dir
from tidemark.sinks import landing as L


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    root = shared_dir(spark, "flagship")
    tag = root.rsplit("/", 1)[1][:10]
    lake = LD.Lake(spark, root, f"flagship_landing_{tag}", f"flagship_staging_{tag}", f"flagship_{tag}")
    lt = lake.landing("FactEod")
    L.append_runs(landing_rows(spark, sf_dir, "FactEod"), lt)
    L.repair(spark, lt)
    LD.merge_landed(spark, lake, "FactEod", {"is_full_reload": True})
    lake.create_views()
    return widen(spark.table(f"{lake.analytics_db}.vw_FactEod"))
