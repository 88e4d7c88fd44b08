"""The newest row of each key, found without ranking every row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedupe


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast", [dedupe.BROADCAST_KEYS, 0])
@pytest.mark.parametrize("keep_null_keys", [True, False])
def test_newest_rows_are_found_before_rows_are_ranked(spark, monkeypatch, broadcast, keep_null_keys):
    monkeypatch.setattr(dedupe, "BROADCAST_KEYS", broadcast)
    h = F.pmod(F.xxhash64("id"), F.lit(36)).cast("int")
    rows = spark.range(5000).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") * 7919 % 300).cast("string")).alias("pk"),
        F.when(F.col("id") % 89 != 0, 20220701 + h % 3).alias("dayId"), F.when(F.col("id") % 97 != 0, h % 12 + 1).alias("runId"),
        (F.col("id") % 41).alias("v"), "id")
    found = dedupe.dedupe_newest(rows, "pk", ["v", "id"], keep_null_keys)
    plan = plan_of(found)
    assert ("BroadcastHashJoin" if broadcast else "Join") in plan and "LeftSemi" in plan
    assert sorted(map(str, found.collect())) == sorted(map(str, dedupe.dedupe_runs(rows, "pk", "latest", ["v", "id"], keep_null_keys).collect()))
