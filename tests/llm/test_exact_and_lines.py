import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_dedup as L
from tidemark.llm.common import left_join_hot, store
from tidemark.llm.exact_dedup import QuotientFilter, exact_dedup, repeated_fingerprints

SPACES = re.compile("[\x20\x09-\x0d]+")


def test_quotient_filters_merge_without_loss():
    r = np.random.default_rng(1)
    parts = [r.integers(0, 1 << 64, 500, dtype=np.uint64) for _ in range(5)]
    parts[3][:100] = parts[0][:100]
    whole = np.concatenate(parts)
    for bits in (0, 1, 7, 20):
        merged = QuotientFilter.of(bits, parts[0])
        for p in parts[1:]:
            merged = merged.merge(QuotientFilter.of(bits, p))
        slots, counts = np.unique(whole, return_counts=True)
        assert (merged.slots == slots).all() and (merged.counts == counts).all()
        back = [QuotientFilter.from_block(bits, q, m, c) for _, q, m, c in merged.blocks(min(bits, 3))]
        assert (np.concatenate([b.slots for b in back]) == slots).all()
    assert list(QuotientFilter.of(5, np.zeros(0, np.uint64)).blocks(2)) == []


def test_repeated_fingerprints_are_those_with_a_count_above_one(spark):
    df = spark.range(0, 3000, numPartitions=7).select((F.col("id") % 1700).alias("k")).select(
        F.xxhash64("k").alias("fingerprint"))
    expected = {r["fingerprint"]: r["n"] for r in df.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").collect()}
    got = {r["fingerprint"]: r["n"] for r in repeated_fingerprints(df, 3000, block_rows=100).collect()}
    assert got == expected


def brute_exact(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(SPACES.sub(" ", text or ""), []).append(i)
    out = []
    for i, text in rows:
        norm = SPACES.sub(" ", text or "")
        ids = [x for x in groups[norm] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_dedup_matches_brute_force(make_docs, prose):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (1, None), (2, ""), (7, " "), (8, " "), (3, "a\tb"), (None, "a b"),
            (None, "alone"), (11, prose(1, 9000)), (10, prose(1, 9000))] + [(100 + i, "hot copy") for i in range(60)]
    got = [tuple(r) for r in exact_dedup(make_docs(rows, extra=True).repartition(5)).collect()]
    assert sorted(got, key=str) == brute_exact(rows)


def test_exact_dedup_of_an_empty_table(make_docs):
    assert exact_dedup(make_docs([])).collect() == []


def test_texts_with_one_fingerprint_are_told_apart_by_their_bytes(make_docs, monkeypatch):
    from tidemark.llm import exact_dedup as E
    monkeypatch.setattr(E.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup(make_docs([(1, "a"), (2, "b"), (3, "a")])).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2)}


@pytest.mark.parametrize("hot", [True, False])
def test_left_join_hot_equals_a_left_join(spark, hot):
    left = spark.range(2000).select(F.when(F.col("id") % 9 == 0, None).when(
        F.lit(hot) & (F.col("id") % 2 == 0), 5).otherwise(F.col("id") % 700).alias("k"), "id")
    right = store(left.filter("k % 3 <> 0").groupBy("k").agg(F.count("*").alias("n")), "test_sizes")
    expected = left.join(right, "k", "left").select("k", "id", "n")
    assert sorted(map(str, left_join_hot(left, right, ["k"], "n", 2000).collect())) == sorted(map(str, expected.collect()))


def test_left_join_hot_spreads_a_hot_key(spark):
    """A third of the rows on one key, no broadcast of the other keys: no task has twice the mean."""
    n, settings = 60_000, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                           "spark.sql.shuffle.partitions": "16"}
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    right = store(left.groupBy("k").agg(F.count("*").alias("n")), "test_hot")
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = left_join_hot(left, right, ["k"], "n", n)
        tasks = [r["count"] for r in joined.filter("n IS NOT NULL").groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(tasks) == n and len(tasks) == 16 and max(tasks) < 2 * n / 16


def brute_lines(rows, min_sites):
    sites, first = {}, {}
    for i, (doc, text, _, site) in enumerate(rows):
        for p, line in enumerate((text or "").split("\n")):
            key = line.strip(" \t\n\x0b\x0c\r")
            if key:
                sites.setdefault(key, set()).add(site)
                first[key] = min(first.get(key, (doc, p, i)), (doc, p, i))
    out = {}
    for doc, text, _, _ in rows:
        kept = []
        for p, line in enumerate((text or "").split("\n")):
            key = line.strip(" \t\n\x0b\x0c\r")
            if not key or len(sites[key]) < min_sites or first[key][:2] == (doc, p):
                kept.append(line)
        out[doc] = "\n".join(kept)
    return out


def test_line_dedup_matches_brute_force(make_docs, prose):
    rows = []
    for i in range(60):
        lines = [prose(i, 12), "shared everywhere", "  shared everywhere ", "", f"on some {i % 20}", prose(i, 3)]
        if i % 4 == 0:
            lines += [f"near {i % 3}"] * 2
        rows.append((i, "\n".join(lines[:2 + i % 6]), "en", f"site{i % 13}"))
    rows += [(100, None, "en", "site1"), (101, "", "en", None), (102, "\n\n", "en", "site2"),
             (103, "\n".join(prose(7, 5) for _ in range(3000)) + "\nshared everywhere", "en", "site3")]
    done = L.line_dedup(make_docs(rows, extra=True), min_sites=4)
    got = {r["row"]["doc_id"]: r["lines"]["cleaned"] or "" for r in done.collect()}
    assert got == brute_lines(rows, 4)
    assert {r["row"]["doc_id"]: r["lines"]["n_lines"] for r in done.collect()}[103] == 3001


def test_line_dedup_counts_near_lines_exactly(spark):
    rows = [(h, 1, f"s{s}") for h in range(6, 16) for s in range(h) for _ in range(3)]
    lines = spark.createDataFrame(rows, "line_hash long, line_chars int, site string")
    got = {r["line_hash"] for r in L.boilerplate(store(lines, "test_lines"), len(rows), 10).collect()}
    assert got == set(range(10, 16))


def brute_threshold(sites):
    shares = [sites.count(s) / len(sites) for s in set(sites)]
    return max(3, int(round(0.7 * sum(1 - (1 - p) ** 20 for p in shares), 6)))


def test_threshold_follows_the_sites_and_their_shares(spark, make_docs, prose):
    """With a third of the documents on one site, passages in 20 documents still go, those in a few stay."""
    import random
    r = random.Random(5)
    sites = ["hot" if r.random() < 1 / 3 else f"s{r.randrange(19)}" for _ in range(900)]
    rows, passages = [(i, prose(i, 30), "en", s) for i, s in enumerate(sites)], [prose(9000 + p, 55) for p in range(15)]
    for p, passage in enumerate(passages):
        for i in r.sample(range(900), 20 if p else 4):
            rows[i] = (*rows[i][:1], rows[i][1] + "\n" + passage, *rows[i][2:])
    even = [f"s{i % 20}" for i in range(400)]
    for given in (sites, even, ["only"] * 5):
        assert L.spread_threshold(spark.createDataFrame([(s,) for s in given], "site string")) == brute_threshold(given)
    assert brute_threshold(sites) < brute_threshold(even) == 8
    got = {x["row"]["doc_id"]: x["lines"]["cleaned"] for x in L.line_dedup(make_docs(rows)).collect()}
    assert got == brute_lines(rows, brute_threshold(sites))
    kept = [sum(passage in text for text in got.values()) for passage in passages]
    assert kept[0] == 4 and kept[1:].count(1) >= 13


def test_line_dedup_edge_cases(make_docs):
    assert L.line_dedup(make_docs([])).collect() == []
    twice = [(1, "x\ny", "en", s) for s in ("a", "b")]  # rows equal in doc_id and text are one
    assert [r["lines"]["cleaned"] for r in L.line_dedup(make_docs(twice), min_sites=2).collect()] == ["x\ny"] * 2
    none = [(None, "x", "en", "a"), (1, "x", "en", "b"), (None, "x\nz", "en", "c")]
    got = sorted((r["row"]["doc_id"] or 0, r["lines"]["cleaned"]) for r in L.line_dedup(make_docs(none), min_sites=2).collect())
    assert got == [(0, ""), (0, "z"), (1, "x")]
