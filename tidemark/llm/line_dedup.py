"""Line dedup by distinct-site spread.

A line's spread is the number of distinct sites that have it. The spread that makes a line boilerplate follows
from the sites and their shares of the documents: it is SPREAD_SHARE of the sites that a line in
SPREAD_DOCS documents, drawn at random, would be expected on. One HyperLogLog sketch per line hash,
merged by aggregation, settles lines far from the threshold; lines near it get an exact distinct
count. Lines at or above the threshold are cross-site boilerplate and go from every document but
the first that has them. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CHARS, WORD, left_join_hot, store, store_counted, text_or_empty

#: Production parameters: documents whose expected spread sets the threshold, the share of it that makes a line
#: boilerplate, and the least threshold; log2 of the sketch's slots.
SPREAD_DOCS = 20
SPREAD_SHARE = 0.7
LEAST_SITES = 3
SKETCH_BITS = 12
#: Estimates within this share of the threshold are counted exactly: over ten standard errors at 2**12 slots.
NEAR = 0.25

_LINE = ["line_hash", "line_chars"]


def _row_key():
    return F.xxhash64("doc_id", "text")


def _lines(docs: DataFrame) -> DataFrame:
    """Lines with a word: their row's key, document, site, position and identity (hash and length)."""
    line = F.btrim("line", F.lit(SPACE_CHARS))
    return (docs.select("doc_id", "site", _row_key().alias("row_key"),
                        F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("pos", "line"))
            .filter(F.col("line").rlike(WORD))
            .select("doc_id", "site", "row_key", "pos", F.xxhash64(line).alias("line_hash"),
                    F.length(line).alias("line_chars")))


def spread_threshold(sites: DataFrame) -> int:
    """The spread that makes a line boilerplate, from ``sites`` (site), a row per document; one number is gathered.

    A site with a third of all documents takes part of every line's documents, so it lowers the spread of all lines.
    """
    counts = sites.groupBy("site").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.lit(float(max(sites.count(), 1)))
    expected = counts.agg(F.sum(1 - F.pow(1 - share, F.lit(SPREAD_DOCS)))).first()[0]
    return max(LEAST_SITES, math.floor(round((expected or 0.0) * SPREAD_SHARE, 6)))


def boilerplate(lines: DataFrame, total: int, min_sites: int) -> DataFrame:
    """(line_hash, line_chars, n_rows) of lines on ``min_sites`` distinct sites or more.

    ``lines`` is a stored table of ``total`` rows. The sketch decides lines whose estimate is far from
    ``min_sites``, an exact distinct count the others.
    """
    spread = store(lines.groupBy(*_LINE)
                   .agg(F.count(F.lit(1)).alias("n_rows"),
                        F.hll_sketch_agg(F.xxhash64("site"), F.lit(SKETCH_BITS)).alias("sketch"))
                   .select(*_LINE, "n_rows", F.hll_sketch_estimate("sketch").alias("estimate")), "op9_spread")
    near = spread.filter(F.col("estimate").between(min_sites * (1 - NEAR), min_sites * (1 + NEAR)))
    exact = (left_join_hot(lines, near, _LINE, "n_rows", total).filter("n_rows IS NOT NULL")
             .groupBy(*_LINE, "n_rows").agg(F.countDistinct("site").alias("n_sites"))
             .filter(F.col("n_sites") >= min_sites).select(*_LINE, "n_rows"))
    sure = spread.filter(F.col("estimate") > min_sites * (1 + NEAR)).select(*_LINE, "n_rows")
    return sure.unionByName(exact)


def line_dedup(docs: DataFrame, min_sites: int | None = None, site: str = "source") -> DataFrame:
    """Two struct columns per row of ``docs`` (doc_id, text, ``site``, others): ``row``, all its columns,
    and ``lines``: n_lines, n_removed and cleaned, the text without boilerplate lines.

    Lines are the
    pieces between newlines, compared without white space at their ends; lines without a word always
    stay. A line found on ``min_sites`` (default: ``spread_threshold``) distinct sites or more stays only where it occurs
    first (by doc_id, null last, then text hash and position). A null site is a site of its own; a null text
    has one empty line and a null result; rows equal in doc_id and text are treated alike, as one.
    """
    base = docs.select("doc_id", "text", F.coalesce(F.col(site).cast("string"), F.lit("\0")).alias("site"))
    lines, total = store_counted(_lines(base), "op9_lines")
    if min_sites is None:
        min_sites = spread_threshold(base.select("site"))
    common = store(boilerplate(lines, total, min_sites), "op9_common")
    found = left_join_hot(lines, common, _LINE, "n_rows", total).filter("n_rows IS NOT NULL")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "pos")
    first = store(found.groupBy(*_LINE).agg(F.min(place).alias("first"), F.first("n_rows").alias("n_rows")), "op9_first")
    extra = (left_join_hot(found.drop("n_rows"), first, _LINE, "n_rows", total)
             .filter(~((F.col("row_key") == F.col("first.row_key")) & (F.col("pos") == F.col("first.pos"))
                       & F.col("doc_id").eqNullSafe(F.col("first.doc_id")))))
    removal = extra.groupBy(F.col("row_key").alias("gone_key"), F.col("doc_id").alias("gone_id")).agg(
        F.collect_set("pos").alias("gone"))
    rows = docs.select(F.struct("*").alias("row"), _row_key().alias("row_key"))
    joined = rows.join(removal, (F.col("row_key") == F.col("gone_key"))
                       & F.col("row.doc_id").eqNullSafe(F.col("gone_id")), "left")
    all_lines = F.split(F.coalesce("row.text", F.lit("")), "\n", -1)
    kept = F.filter(all_lines, lambda _, i: ~F.array_contains("gone", i))
    whole = F.col("gone").isNull()
    return joined.select("row", F.struct(
        F.size(all_lines).cast("long").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(whole, F.col("row.text")).otherwise(F.array_join(kept, "\n")).alias("cleaned")).alias("lines"))
