import collections
import hashlib
import math
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import quality as Q
from tidemark.llm import warc as W

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), failed)


def test_hash_of_words_is_the_public_one(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("wörd")).alias("h")).first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest("wörd".encode(), seed=42)


def scores(rows, trusted, buckets):
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def pair(a, b):  # Spark's hash of two longs: the second seeded by the hash of the first
        one = xxhash.xxh64_intdigest((a % (1 << 64)).to_bytes(8, "little"), seed=42)
        return signed(xxhash.xxh64_intdigest((b % (1 << 64)).to_bytes(8, "little"), seed=one))

    def grams(text):
        h = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in WORD.findall(text or "")]
        return [x % buckets for x in h + [pair(a, b) for a, b in zip(h, h[1:], strict=False)]]

    every, target = collections.Counter(), collections.Counter()
    for i, text in rows:
        every.update(grams(text))
        if i in trusted:
            target.update(grams(text))
    n, m = sum(every.values()), sum(target.values())
    ratio = {b: math.log((target[b] + 1) / (m + buckets)) - math.log((every[b] + 1) / (n + buckets)) for b in range(buckets)}
    return [sum(ratio[g] for g in grams(t)) / len(grams(t)) if grams(t) else 0.0 for _, t in rows]


def test_quality_matches_brute_force(make_docs, prose):
    rows = [(i, prose(i % 50, 5 + i * 3)) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \n\t\x0b"), (103, "a b c d e f a b c d e g h i j k l m n o p q r s t"),
             (104, "x " * 5000), (105, "one line\none line\n\n  \none line"), (106, "#$ &| <> %* words & more of them, ten at least #"),
             (107, "ß é nbsp stays in one word " * 3), (None, prose(3, 40)), (108, prose(9, 12)), (108, prose(9, 12)), (109, prose(5, 30_000))]
    trusted = set(range(0, 30))
    labels = make_docs([(i, "x") for i in [*trusted, 7, 999]]).select("doc_id")
    got = Q.quality(make_docs(rows, extra=True), labels, min_score=-0.01, buckets=256).collect()
    expected = collections.Counter((i, *base(t), round(s, 6), (not base(t)[-1]) and round(s, 9) >= -0.01)
                                   for (i, t), s in zip(rows, scores(rows, trusted, 256), strict=True))
    assert collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                                r["base_failed"], round(r["score"], 6), r["kept"]) for r in got) == expected


def test_quality_without_rows_or_trusted_documents(make_docs):
    nobody = make_docs([]).select("doc_id")
    assert Q.quality(make_docs([]), nobody).collect() == []
    assert Q.quality(make_docs([(1, "w " + "x y z " * 5)]), nobody, buckets=64).count() == 1


def test_trusted_labels_leave_out_toxic_and_bad_ones(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 1, None), (5, None, 0)], "doc_id long, quality int, toxic int")
    assert sorted(r[0] for r in Q.trusted_labels(df).collect()) == [1, 4]


PAGE = "page_id long, url string, html string, record_id string, type string"


def pages(spark):
    big, tricky = "<p>" + "x" * 120, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "é" * 60
    rows = [(3, "http://a/1", big), (1, "http://a/2", big), (2, None, big), (9, "http://a b\r\nc", tricky), (4, "u", tricky),
            (5, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"), (None, "u", big), (1, "http://a/2", big),
            (10, "u", "y" * 99), (11, "u", "y" * 99), (12, "u", "z" * 100), (13, "u", "z" * 100), (14, "u", "\r\n\r\n" * 50),
            (15, "u", "long " * 400_000)]
    return spark.createDataFrame([(*r, "n", "n") for r in rows], PAGE), rows


def test_archives_round_trip(spark):
    df, rows = pages(spark)
    first = {}
    for i, _, page in rows:
        if i is not None and len((page or "").encode()) >= 100:
            first[page] = min(i, first.get(page, i))
    expected = []
    for i, _, page in rows:
        raw = (page or "").encode()
        refers = first.get(page) if len(raw) >= 100 and first.get(page) != i else None
        expected.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if refers is not None else "response", refers))
    got = [tuple(r) for r in W.resolve(W.archive_and_read(df)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_captures_nest_whole_payloads(spark):
    from tidemark.session import shared_dir
    df, rows = pages(spark)
    path = shared_dir(spark, "test_warc")
    W.write_warc(df, path, file_bytes=500)
    found = W.captures(W.read_records(spark, path)).collect()
    assert len(found) == len(rows)
    payloads = collections.Counter(bytes(r["response"]["block"]).partition(b"\r\n\r\n")[2].decode() for r in found
                                   if r["response"]["type"] == "response")
    assert payloads[rows[4][2]] == 1 and payloads[rows[15][2]] == 1 and payloads[""] == 2
    assert all(r["request"]["concurrent_to"] == r["response"]["record_id"] == r["metadata"]["concurrent_to"] for r in found)
    assert all(bytes(r["request"]["block"]).startswith(b"GET /") or b"GET " in bytes(r["request"]["block"]) for r in found)


def test_captures_join_either_way_and_pick_one(spark):
    from tidemark.llm.warc import _RECORD

    def record(kind, record_id, concurrent=None):
        return (kind, record_id, concurrent, None, None, None, None, 0, "d", None)

    df = spark.createDataFrame([record("response", "r1"), record("request", "q1", "r1"), record("request", "q0", "r1"),
                                record("metadata", "m1", "r1"), record("request", "q2"), record("response", "r2", "q2"),
                                record("revisit", "r3"), record("request", "lost", "nowhere"), record("warcinfo", "w")], _RECORD)
    got = {r["response"]["record_id"]: (r["request"] and r["request"]["record_id"], r["metadata"] and r["metadata"]["record_id"])
           for r in W.captures(df).collect()}
    assert got == {"r1": ("q0", "m1"), "r2": ("q2", None), "r3": (None, None)}


def test_no_pages_and_broken_archives(spark):
    df, _ = pages(spark)
    assert W.resolve(W.archive_and_read(df.limit(0))).collect() == []
    with pytest.raises(ValueError, match="shorter"):
        list(W.parse_records(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort"))
    with pytest.raises(ValueError, match="not a WARC"):
        list(W.parse_records(b"HTTP/1.1 200 OK\r\n\r\n"))
    assert list(W.parse_records(b"")) == []
