"""Near-duplicate classes by order MinHash.

A text's k-mers are its five-word windows, each labelled with its occurrence number. A sketch takes the
SAMPLED k-mers that are smallest under one hash function and keeps them in text order, so it agrees only
where both content and order agree. Texts with an equal sketch are candidates. Short texts have too few
k-mers for that: they are also candidates where they share one of their rarest k-mers, so many of them
that two near texts always do (prefix filtering). A candidate pair is
verified by a banded alignment of the words: its similarity is the windows that the alignment
conserves over the windows of both texts, and 0.8 or more links them. Classes are the connected
components of the links.

Two exact bounds settle most pairs of texts that are merely related: windows that only one
component has are shared with no other, and texts share no more windows than they have of the same
hash classes. Of buckets with equal members one is kept. Each text is compared with one central text of its
buckets, then with central texts of the largest root of each; texts that are connected by then need no
comparison, and of the others every pair that shares a bucket, and that the bounds leave open, is compared.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import HOT_PARTS, dealt, left_join_hot, matched_hot, store, store_counted
from tidemark.llm.components import components

#: Production parameters.
WINDOW = 5
SIMILARITY = 0.8
SKETCHES = 40
SAMPLED = 7
#: Texts with up to SHORT windows are found exactly: so are all near pairs of which one has up to 0.8 SHORT.
SHORT = 80
#: Central texts of a bucket's main root that the others are dealt to.
PIVOTS = 8
#: Hash classes that a text's windows are counted by.
CLASSES = 128

_SALTS = 64
_CELLS = 1 << 21
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(32))


_SEEDS = _mix(np.arange(1, 4097, dtype=np.uint64) * _M1)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words, which ASCII white space parts."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, object), categorize=False)


def windows(words: np.ndarray, k: int = WINDOW) -> np.ndarray:
    """Hashes of the k-word windows; a shorter text is one window, an empty one none."""
    if not len(words):
        return words
    n = max(1, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(k, len(words))):
        out = _mix(out + words[i:i + n] * _M1 + np.uint64(i + 1))
    return out


def labelled(kmers: np.ndarray) -> np.ndarray:
    """The k-mers' hashes together with the number of equal ones before each."""
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]] if len(kmers) else np.zeros(0, bool)
    occurrence = np.empty(len(kmers), np.uint64)
    at = np.arange(len(kmers))
    occurrence[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return _mix(kmers + occurrence * _M1)


def order_sketches(kmers: np.ndarray, sketches: int = SKETCHES, sampled: int = SAMPLED) -> np.ndarray:
    """``sketches`` hashes, each of the ``sampled`` smallest labelled k-mers in text order (of all, if fewer)."""
    if not len(kmers):
        return np.zeros(sketches, np.uint64)
    take = min(sampled, len(kmers))
    out = np.empty(sketches, np.uint64)
    step = max(1, _CELLS // len(kmers))
    for i in range(0, sketches, step):
        seeds = _SEEDS[i:min(i + step, sketches), None]
        values = (kmers[None, :] ^ seeds) * _M1
        values ^= values >> np.uint64(29)
        values *= _M2
        least = np.argpartition(values, take - 1, axis=1)[:, :take] if take < len(kmers) else \
            np.broadcast_to(np.arange(take), (len(seeds), take))
        chosen = kmers[np.sort(least, axis=1)]
        folded = np.zeros(len(seeds), np.uint64)
        for j in range(take):
            folded = _mix(folded + chosen[:, j] * _M1 + np.uint64(1))
        out[i:i + len(seeds)] = _mix(folded ^ seeds[:, 0])
    return out


def text_key(words: np.ndarray) -> int:
    """A 64-bit hash of the words in their order."""
    placed = _mix(words + np.arange(1, len(words) + 1, dtype=np.uint64) * _M1)
    return int(_mix(np.add.reduce(placed, keepdims=True)).view(np.int64)[0]) if len(words) else 0


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for a in range(0, len(batch), 512):
            rows = []
            for doc_id, text, text_hash in zip(batch["doc_id"][a:a + 512], batch["text"][a:a + 512], batch["text_hash"][a:a + 512],
                                               strict=True):
                words = word_hashes(text)
                kmers = windows(words)
                marked = labelled(kmers)
                short = marked if WINDOW <= len(words) and len(kmers) <= SHORT else marked[:0]
                rows.append((doc_id, text_hash, text_key(words), len(words), len(kmers),
                             order_sketches(marked).view(np.int64).tolist(), short.view(np.int64).tolist()))
            yield pd.DataFrame(rows, columns=["doc_id", "text_hash", "text_key", "n_words", "n_kmers", "sketches", "short"])


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [labelled(windows(word_hashes(text))).view(np.int64).tolist() for text in batch["text"]]
        yield pd.DataFrame({"node": batch["node"], "root": batch["root"], "windows": found})


def _classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [np.bincount((labelled(windows(word_hashes(text))) % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES)
                 .tolist() for text in batch["text"]]
        yield pd.DataFrame({"node": batch["node"], "classes": found})


def _short_buckets(texts: DataFrame, least: float) -> DataFrame:
    """(node, n_kmers, bucket): the rarest windows of each short text, as many as it can't all lack of a near one's.

    Near texts of n windows and more share ``least`` * n, so two of them that order their windows alike share one of
    the first n - ceil(least * n) + 1. Windows of one text alone come first in that order and need no bucket.
    """
    rows, total = store_counted(texts.select("node", "n_kmers", F.explode("short").alias("window")), "op7_short")
    counts = store(rows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "op7_short_counts")
    found = matched_hot(rows, counts, ["window"], "n", total)
    texts = found.groupBy("node", "n_kmers").agg(F.sort_array(F.collect_list(F.struct("n", "window"))).alias("ranked"))
    prefix = F.col("n_kmers") - F.ceil(F.col("n_kmers") * least - F.lit(1e-6)) + 1
    take = F.greatest(F.lit(0), prefix - (F.col("n_kmers") - F.size("ranked"))).cast("int")
    return texts.select("node", "n_kmers", F.explode(F.slice("ranked", F.lit(1), take)).alias("of")).select(
        "node", "n_kmers", F.xxhash64(F.lit(-1), F.col("of.window")).alias("bucket"))


def _own_windows(texts: DataFrame, placed: DataFrame) -> DataFrame:
    """(node, own): how many labelled windows of each text of ``placed`` (node, root) only texts of its
    root have. No text of another root shares them."""
    rows, total = store_counted(texts.join(placed, "node").mapInPandas(_windows, "node long, root long, windows array<long>")
                                .select("node", "root", F.explode("windows").alias("window")), "op7_windows")
    alone = store(rows.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
                  .filter("lo = hi").select("window", "n"), "op7_alone")
    return matched_hot(rows, alone, ["window"], "n", total).groupBy("node").agg(F.count(F.lit(1)).alias("own"))


def _enough(least: float, shared: Column, kmers: str, other_kmers: str) -> Column:
    """Are ``shared`` windows enough for two texts to be near?"""
    return shared * (1 + least) >= (F.col(kmers) + F.col(other_kmers)) * least - F.lit(1e-6)


def _can_be_near(least: float, kmers: str, own: str, other_kmers: str, other_own: str) -> Column:
    """False where two texts can't share enough windows: neither shares the windows that its root alone has."""
    return _enough(least, F.least(F.col(kmers) - F.col(own), F.col(other_kmers) - F.col(other_own)), kmers, other_kmers)


def _shared_classes(classes: str, other_classes: str) -> Column:
    """No fewer windows than two texts share: those of the same hash classes."""
    return F.aggregate(F.zip_with(classes, other_classes, lambda a, b: F.least(a, b)), F.lit(0), lambda n, x: n + x)


def _same_to(a: np.ndarray, b: np.ndarray, x: int, y: int) -> int:
    """How many elements agree from a[x] and b[y] on."""
    n, step, most = 0, 32, min(len(a) - x, len(b) - y)
    while n < most:
        size = min(step, most - n)
        differ = a[x + n:x + n + size] != b[y + n:y + n + size]
        at = int(differ.argmax())
        if differ[at]:
            return n + at
        n, step = n + size, step * 4
    return n


def alignment(a: np.ndarray, b: np.ndarray, band: int) -> np.ndarray | None:
    """For each element of ``a`` the index of its partner in ``b`` or -1, on a path with the fewest insertions
    and deletions; None if it needs more than ``band`` of them, for which only the band is searched."""
    partner = np.full(len(a), -1, np.int64)
    front = _same_to(a, b, 0, 0)
    back = min(_same_to(a[::-1], b[::-1], 0, 0), min(len(a), len(b)) - front)
    partner[:front] = np.arange(front)
    if back:
        partner[len(a) - back:] = np.arange(len(b) - back, len(b))
    s, t = a[front:len(a) - back], b[front:len(b) - back]
    n, m = len(s), len(t)
    if abs(n - m) > band:
        return None
    if not n or not m:
        return partner if n + m <= band else None
    ls, lt = s.tolist(), t.tolist()
    reach = [0] * (2 * band + 3)  # furthest x on diagonal x - y, at index diagonal + band + 1
    past: list[array] = []
    zero = band + 1
    for d in range(band + 1):
        past.append(array("i", reach[zero - d - 1:zero + d + 2]))
        for k in range(-d, d + 1, 2):
            if k == -d or k != d and reach[zero + k - 1] < reach[zero + k + 1]:
                x = reach[zero + k + 1]
            else:
                x = reach[zero + k - 1] + 1
            y = x - k
            if x < n and 0 <= y < m and ls[x] == lt[y]:
                x += _same_to(s, t, x, y)
            reach[zero + k] = x
            if x >= n and x - k >= m:
                return _trace(past, d, n, m, front, partner)
    return None


def _trace(past: list[array], d: int, n: int, m: int, front: int, partner: np.ndarray) -> np.ndarray:
    x, y = n, m
    while d >= 0:
        k, reach = x - y, past[d]  # reach[k + d + 1] is the furthest x on diagonal k before round d
        if d == 0:
            start = 0
        else:
            down = k == -d or k != d and reach[k + d] < reach[k + d + 2]
            start = reach[k + d + 2] if down else reach[k + d] + 1
        partner[front + start:front + x] = np.arange(front + start - k, front + x - k)
        if d:
            x = start if down else start - 1
            y = x - (k + 1 if down else k - 1)
        d -= 1
    return partner


def _profile(words: np.ndarray, k: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The words and their labelled windows, sorted."""
    return words, np.sort(labelled(windows(words, k)))


def conserved_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY, k: int = WINDOW) -> float:
    """Windows that the alignment of the word hashes conserves / windows of either text; 0 where it must be
    under ``least``."""
    return _similarity(_profile(a, k), _profile(b, k), least, k)


def _similarity(u: tuple[np.ndarray, np.ndarray], v: tuple[np.ndarray, np.ndarray], least: float, k: int = WINDOW) -> float:
    (a, la), (b, lb) = u, v
    if not len(la) or not len(lb):
        return float(len(la) == len(lb))
    if len(a) < k or len(b) < k:
        return float(len(a) == len(b) and bool((a == b).all()))
    needed = least / (1 + least) * (len(la) + len(lb))
    shared = int((la[np.minimum(np.searchsorted(la, lb), len(la) - 1)] == lb).sum())
    if shared < needed - 1e-9:
        return 0.0  # an alignment conserves no more windows than the texts share
    # Every unpartnered word but four at each text's start ends a window of its own that isn't conserved.
    band = int((len(la) + len(lb)) * (1 - least) / (1 + least)) + 2 * (k - 1)
    partner = alignment(a, b, band)
    if partner is None:
        return 0.0
    follows = (partner[1:] == partner[:-1] + 1) & (partner[:-1] >= 0)
    run = np.concatenate([[0], np.cumsum(follows)])
    conserved = int((run[k - 1:] - run[:-(k - 1)] == k - 1).sum())
    return conserved / (len(la) + len(lb) - conserved)


@lru_cache(maxsize=256)
def _cached_profile(text: str) -> tuple[np.ndarray, np.ndarray]:
    return _profile(word_hashes(text))


def _verify(least: float):
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_similarity(_cached_profile(x), _cached_profile(y), least)
                     for x, y in zip(batch["text_u"], batch["text_v"], strict=True)]
            yield pd.DataFrame({"u": batch["u"], "v": batch["v"], "similarity": found})
    return verify


def _verified(pairs: DataFrame, total: int, texts: DataFrame, least: float) -> DataFrame:
    """The ``total`` stored ``pairs`` (u, v) that have a similarity of ``least`` or more. A pivot v may be in most pairs:
    its text is dealt out in _SALTS copies then."""
    hubs = pairs.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * HOT_PARTS >= total + HOT_PARTS * 64)
    hubs = store(hubs.select("v"), "op7_hubs")  # at most HOT_PARTS
    salt = F.pmod(F.xxhash64("u"), F.lit(_SALTS)).cast("int")
    salted = (pairs.join(F.broadcast(hubs.withColumn("hub", F.lit(True))), "v", "left")
              .withColumn("salt", F.when(F.col("hub"), salt).otherwise(F.lit(0))).drop("hub"))
    copies = F.when(F.col("hub"), F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    of_v = (texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
            .join(F.broadcast(hubs.withColumn("hub", F.lit(True))), "v", "left")
            .select("v", "text_v", F.explode(copies).alias("salt")))
    joined = (salted.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
              .join(of_v, ["v", "salt"]).select("u", "v", "text_u", "text_v"))
    return joined.mapInPandas(_verify(least), "u long, v long, similarity double").filter(F.col("similarity") >= least)


def _buckets(texts: DataFrame, n_texts: int, least: float) -> tuple[DataFrame, int]:
    """(node, n_kmers, bucket) of the buckets that two texts or more share, and how many rows; of buckets with the same
    members one."""
    rows = (texts.filter(F.col("n_words") >= WINDOW)
            .select("node", "n_kmers", F.posexplode("sketches").alias("band", "sketch"))
            .select("node", "n_kmers", F.xxhash64("band", "sketch").alias("bucket"))
            .unionByName(_short_buckets(texts, least)))
    members = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two")
    alike = rows.groupBy("bucket").agg(*members).filter("n > 1").groupBy("n", "one", "two").agg(F.min("bucket").alias("bucket"))
    found = matched_hot(rows, store(alike.select("bucket", "n"), "op7_shared"), ["bucket"], "n", n_texts * SKETCHES)
    return store_counted(found.drop("n"), "op7_buckets")


class _Matcher:
    """Verifies candidate pairs, none twice, and keeps the links."""

    def __init__(self, texts: DataFrame, least: float):
        self.texts, self.least = texts, least
        self.tried = self.links = texts.sparkSession.createDataFrame([], "u long, v long")

    def link(self, pairs: DataFrame) -> tuple[DataFrame, int]:
        """The links among ``pairs`` (u, v), without repeats, and how many they are."""
        fresh, total = store_counted(pairs.select("u", "v").join(self.tried, ["u", "v"], "left_anti"), "op7_pairs")
        if not total:
            return fresh, 0
        found, n = store_counted(_verified(fresh, total, self.texts, self.least).select("u", "v"), "op7_links")
        self.tried = self.tried.unionByName(fresh).unionByName(fresh.select(F.col("v").alias("u"), F.col("u").alias("v")))
        self.links = self.links.unionByName(found)
        return found, n


def _open_rows(rows: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Of ``total`` stored ``rows`` (node, bucket, root, others) those of buckets with several roots, with ``main``, the
    bucket's most frequent one."""
    roots = dealt(rows, total, "bucket").groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("of_root"))
    mains = (roots.groupBy("bucket").agg(F.max_by("root", F.struct("of_root", "root")).alias("main"), F.sum("of_root").alias("n"),
                                         F.count(F.lit(1)).alias("n_roots")).filter("n_roots > 1").drop("n_roots"))
    return store_counted(matched_hot(rows, store(mains, "op7_mains"), ["bucket"], "n", total).drop("n"), "op7_open")


def _candidate_links(texts: DataFrame, shared: DataFrame, total: int, least: float) -> DataFrame:
    """(u, v): links that connect all texts which near pairs of a bucket connect.

    ``shared`` is (node, n_kmers, bucket), of ``total`` rows. First each text meets one text: of its buckets' most
    central ones (fewest windows of their own) the most central. What is linked to one text is one root. In buckets
    with several roots, the texts outside the main root then meet one of its central texts a bucket. Of what is left,
    two roots meet in the pair of texts whose hash classes agree most, and, if that is no link, in all pairs that
    share a bucket and that the bounds leave open.
    """
    def told_apart(rows: DataFrame) -> DataFrame:
        """Rows with ``own``; texts with too few other windows to be near one of another root go."""
        own = _own_windows(texts, rows.select("node", "root").distinct())
        counted = rows.drop("own").join(own, "node", "left").fillna(0, ["own"])
        return counted.filter(F.col("n_kmers") - F.col("own") >= F.col("n_kmers") * least - F.lit(1e-6))

    matcher = _Matcher(texts, least)
    now, total = store_counted(told_apart(shared.withColumn("root", F.col("node"))), "op7_near_buckets")
    if not total:
        return matcher.links
    central = dealt(now, total, "bucket").groupBy("bucket").agg(
        F.min(F.struct("own", "node", "n_kmers")).alias("p"), F.count(F.lit(1)).alias("n"))
    met = matched_hot(now, store(central, "op7_central"), ["bucket"], "n", total).filter(
        (F.col("node") != F.col("p.node")) & _can_be_near(least, "n_kmers", "own", "p.n_kmers", "p.own"))
    first, n = matcher.link(dealt(met, total, "node").groupBy(F.col("node").alias("u")).agg(F.min(F.struct("p.own", "p.node")).alias("p"))
                            .select("u", F.col("p.node").alias("v")))
    centres = dealt(first, n, "v").select("v").distinct()
    labels = first.join(centres.withColumnRenamed("v", "u"), "u", "left_anti").unionByName(centres.select(F.col("v").alias("u"), "v"))
    now = now.drop("root").join(labels.toDF("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    now, total = _open_rows(store(now, "op7_rooted"), total)
    if not total:
        return matcher.links

    part = F.pmod(F.xxhash64("node"), F.lit(PIVOTS))
    pivots = (dealt(now.filter("root = main"), total, "bucket").groupBy("bucket", part.alias("part"))
              .agg(F.min(F.struct("own", "node", "n_kmers", "root")).alias("p")).groupBy("bucket").agg(F.collect_list("p").alias("pivots")))
    others, n_others = store_counted(now.filter("root <> main"), "op7_others")
    sizes = dealt(others, n_others, "bucket").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    met = matched_hot(others, store(pivots.join(sizes, "bucket"), "op7_pivots"), ["bucket"], "n", n_others)
    one = F.element_at("pivots", (F.pmod(F.xxhash64("node", "bucket"), F.size("pivots")) + 1).cast("int"))
    met = met.withColumn("p", one).filter(_can_be_near(least, "n_kmers", "own", "p.n_kmers", "p.own"))
    second, n = matcher.link(dealt(met.select(F.col("node").alias("u"), F.col("p.node").alias("v")), n_others, "u").distinct())
    if n:
        roots = store(dealt(now.select("node", "root"), total, "node").distinct(), "op7_roots")
        hooked = (dealt(second, n, "u").join(roots.toDF("u", "old"), "u").join(roots.toDF("v", "new"), "v")
                  .groupBy(F.col("old").alias("root")).agg(F.min("new").alias("new")))
        now = now.drop("main").join(store(hooked, "op7_hooked"), "root", "left").withColumn("root", F.coalesce("new", "root")).drop("new")
        now, total = _open_rows(store(now, "op7_rerooted"), total)
        if not total:
            return matcher.links

    nodes = dealt(now.select("node"), total, "node").distinct()
    classes = texts.join(nodes, "node", "left_semi").mapInPandas(_classes, "node long, classes array<int>")
    now, total = store_counted(told_apart(now).join(classes, "node"), "op7_last")
    # A pair meets in the first bucket that both are in, so once.
    now = now.join(dealt(now.select("node", "bucket"), total, "node").groupBy("node").agg(F.collect_set("bucket").alias("buckets")), "node")
    other = now.filter("root <> main").select("bucket", F.col("node").alias("u"), F.col("root").alias("u_root"), F.col("n_kmers").alias("u_kmers"),
                                              F.col("own").alias("u_own"), F.col("classes").alias("u_classes"), F.col("buckets").alias("u_buckets"))
    agree = _shared_classes("u_classes", "classes")
    met = other.join(now.withColumnRenamed("node", "v"), "bucket").filter(
        (F.col("u_root") != F.col("root")) & ((F.col("root") == F.col("main")) | (F.col("u") > F.col("v")))
        & _can_be_near(least, "u_kmers", "u_own", "n_kmers", "own")
        & (F.col("bucket") == F.array_min(F.array_intersect("u_buckets", "buckets")))
        & _enough(least, agree, "u_kmers", "n_kmers"))
    pairs = store(met.select("u", "v", "u_root", "root", (agree / (F.col("u_kmers") + F.col("n_kmers"))).alias("agree")), "op7_left")
    best = pairs.groupBy("u_root", "root").agg(F.max(F.struct("agree", "u", "v")).alias("p")).select(
        "u_root", "root", "p.u", "p.v")
    best = store(best, "op7_best")
    third, n = matcher.link(best.select("u", "v"))
    settled = best.join(third, ["u", "v"], "left_semi").select("u_root", "root")
    matcher.link(pairs.join(settled, ["u_root", "root"], "left_anti"))
    return matcher.links


def near_dedup(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text): doc_id, text_hash (xxhash64), class_id, class_size and kept.

    class_id is the smallest doc_id of the class; that row is kept. Texts with the same words in the same
    order are one text. Under five words a text is near only to equal ones; texts without words, null
    or empty, are equal. Rows that share a doc_id are one document, linked by any of its texts. A row without
    doc_id joins the class of equal texts that have one; without any it is kept, with null class_id.
    An empty table gives no rows; other columns are not read.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    schema = "doc_id long, text_hash long, text_key long, n_words long, n_kmers long, sketches array<long>, short array<long>"
    marks, total = store_counted(named.mapInPandas(_sketch, schema), "op7_marks")
    text_of = ["text_key", "n_words"]
    # Texts are nodes. Equal ones have equal sketches, so any will do.
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))
    nodes, n_nodes = store_counted(
        marks.groupBy(*text_of).agg(F.min(row).alias("row"), F.count(F.lit(1)).alias("n"), F.first("n_kmers").alias("n_kmers"),
                                    F.first("sketches").alias("sketches"), F.first("short").alias("short"))
        .select(F.monotonically_increasing_id().alias("node"), *text_of, "n", "n_kmers", "sketches", "short", F.col("row.doc_id").alias("rep"),
                F.col("row.text_hash").alias("rep_hash")), "op7_nodes")
    named_nodes = nodes.filter("rep IS NOT NULL")
    shared, n_shared = _buckets(named_nodes, n_nodes, least)
    of_node = named_nodes.join(shared.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("rep").alias("doc_id"), F.col("rep_hash").alias("text_hash"))
    texts = store(named.join(of_node, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]).select("node", "text"), "op7_texts")
    links = _candidate_links(texts, shared, n_shared, least)
    # A document of several texts links them.
    several = (marks.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(*text_of)).alias("lo"), F.max(F.struct(*text_of)).alias("hi"))
               .filter("lo <> hi").select("doc_id"))
    own_texts = marks.join(several, "doc_id", "left_semi").select("doc_id", *text_of).distinct().join(
        nodes.select(*text_of, "node"), text_of)
    joint = own_texts.groupBy("doc_id").agg(F.min("node").alias("v")).join(own_texts, "doc_id").select(F.col("node").alias("u"), "v")
    roots = components(links.unionByName(joint))

    classes = named_nodes.select("node", *text_of, "n", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    whole = classes.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("n").alias("class_size"))
    named_classes = store(classes.join(whole, "root").select(*text_of, "n", "class_id", "class_size"), "op7_classes")
    joined = left_join_hot(marks.select("doc_id", "text_hash", *text_of), named_classes, text_of, "n", total)
    alone = F.col("class_id").isNull()
    return joined.select("doc_id", "text_hash", "class_id", F.when(alone, 1).otherwise(F.col("class_size")).cast("long").alias("class_size"),
                         (alone | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))
