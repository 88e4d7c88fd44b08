import collections
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding as S
from tidemark.llm.common import store


def check(rows, out, shards=16):
    """Counts at most one apart, slots gapless, size and checksum of every row."""
    got = [tuple(r) for r in out]
    expected = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    assert sorted((g[:3] for g in got), key=str) == sorted(expected, key=str)
    slots = collections.defaultdict(list)
    for g in got:
        slots[g[3]].append(g[4])
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def together(rows, out):
    """Rows in the shard that holds most of their group / rows, over groups of two and more."""
    where = collections.defaultdict(collections.Counter)
    for r in out:
        where[r["text_crc32"], r["size"]][r["shard"]] += 1
    groups = [c for c in where.values() if sum(c.values()) > 1]
    return sum(max(c.values()) for c in groups) / max(1, sum(sum(c.values()) for c in groups))


CASES = {
    "pairs among single ones": ([(i, f"t{i // 2 if i < 400 else i}") for i in range(1600)], 1.0),
    "all in threes": ([(i, f"t{i % 400}") for i in range(1200)], 0.9),
    "a third on one text": ([(i, "hot" if i % 3 == 0 else f"t{i // 6}") for i in range(1500)], 0.6),
    "one text": ([(i, "x") for i in range(100)], 0.06),
    "groups above a shard": ([(i, f"g{i % 10}") for i in range(800)], 0.5),
}


@pytest.mark.parametrize("case", CASES)
def test_links_stay_together_under_even_counts(make_docs, case):
    rows, least = CASES[case]
    out = S.shard(make_docs(rows).repartition(5)).collect()
    check(rows, out)
    assert together(rows, out) >= least


def test_nulls_repeats_and_clashing_names(make_docs):
    rows = [(None, None), (1, None), (1, ""), (2, "a"), (2, "a"), (2, "b"), (None, "a"), (3, "é" * 200_000)]
    check(rows, S.shard(make_docs(rows, extra=True).withColumnRenamed("key", "node").withColumnRenamed("row", "hub")).collect())


@pytest.mark.parametrize("n", [0, 1, 5, 17])
def test_few_rows(make_docs, n):
    rows = [(i, f"t{i % 2}") for i in range(n)]
    check(rows, S.shard(make_docs(rows)).collect())


def test_links_by_another_column(spark, make_docs):
    docs = make_docs([(i, f"t{i}", "en", None if i % 4 == 0 else f"s{i % 40}") for i in range(400)])
    out = {r["doc_id"]: r["shard"] for r in S.shard(docs, group=F.col("source"), shards=4).collect()}
    groups = collections.defaultdict(collections.Counter)
    for i, s in out.items():
        if i % 4:
            groups[i % 40][s] += 1
    assert all(len(c) == 1 for c in groups.values()) and max(collections.Counter(out.values()).values()) == 100


def test_nodes_of_several_hubs_follow_the_larger_pull(spark):
    """Two cliques of 20, each linked by pairs in a ring too, and a node with one link to the first and three to the second."""
    links = [(i, 1) for i in range(20)] + [(i, 2) for i in range(20, 40)] + [(99, 1), (99, 3), (20, 3), (99, 4), (21, 4), (99, 5), (22, 5)]
    links += [(i, 100 + i) for i in range(19)] + [(i + 1, 100 + i) for i in range(19)]
    out = dict(S.propagate(spark.createDataFrame(links, "node long, hub long"), 4, 30).collect())
    assert len(set(out[i] for i in range(20))) == 1 and len(set(out[i] for i in range(20, 40))) == 1


def test_admitted_flows_keep_the_quota():
    demand = {(0, 1): 50, (1, 0): 20, (2, 1): 30, (1, 2): 5, (0, 2): 10}
    load, capacity = [100, 100, 90], 100
    share = S.admitted(demand, load, capacity)
    for s in range(3):
        into = sum(n * share[f] for f, n in demand.items() if f[1] == s)
        out = sum(n * share[f] for f, n in demand.items() if f[0] == s)
        assert load[s] + into - out <= capacity + 0.01
    assert all(0 <= x <= 1 for x in share.values()) and share[(1, 0)] > 0.99
    assert S.admitted({}, [0], 1) == {}


def test_ranks_with_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(S, "_BUCKET_ROWS", 16)
    n = F.when(F.col("id") % 3 == 0, 334).otherwise(1)
    rows = store(spark.range(1000).select(F.col("id").alias("node"), F.when(n > 1, F.lit(5).cast("long")).otherwise(F.xxhash64("id")).alias("hub"),
                                          n.alias("n"), S._draw("id").alias("drawn"), (n == 1).alias("late"),
                                          F.pmod("id", F.lit(3)).cast("int").alias("shard")), "test_ranks")
    places = collections.defaultdict(list)
    for r in S._ranked(rows, ["shard"], 1000, "place").collect():
        places[r["shard"]].append(r["place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(places) == 3
