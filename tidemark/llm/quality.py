"""Quality rules: base counts and a hashed n-gram log-likelihood ratio. DataFrame functions only.

Words and word pairs are hashed into buckets. One multinomial over the buckets comes from trusted
documents, one from all documents; a document's score is the mean log ratio of its n-grams. Every
document is kept or dropped by the same fixed threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, WORD, store, text_or_empty

# The base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

#: Production parameters: hash buckets, additive smoothing, trusted documents fitted on at most, threshold.
BUCKETS = 1 << 16
SMOOTHING = 1.0
MAX_TRUSTED = 20_000
MIN_SCORE = -0.15


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words inside five-word windows that the text has twice or more (windows compared by 64-bit hash)."""
    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
                           lambda _, i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def repeated(s: Column) -> Column:
        return F.array_sort(F.transform(F.filter(
            s, lambda x, i: F.get(s, i - 1)["h"].eqNullSafe(x["h"]) | F.get(s, i + 1)["h"].eqNullSafe(x["h"])),
            lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)),
                                                               F.lit(WINDOW))), F.lit(0), lambda a, x: a + x)

    def count(w: Column) -> Column:  # most texts repeat no window and need no sort
        placed = F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(
            _let(F.sort_array(placed), lambda s: _let(repeated(s), covered)))

    return _let(windows(hashes), count)


def _buckets(hashes: Column, buckets: int) -> Column:
    """Buckets of the words and of the pairs of neighbouring words."""
    pairs = F.transform(F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))),
                        lambda second, i: F.xxhash64(F.get(hashes, i), second))
    return F.transform(F.concat(hashes, pairs), lambda x: F.pmod(x, F.lit(buckets)).cast("int"))


def base_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, the base counts and the n-gram buckets of every row of ``docs`` (null text: no word)."""
    text = text_or_empty()
    symbol = "[" + SYMBOLS + "]"
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    symbols = F.when(text.rlike(symbol), F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).otherwise(0)
    words = docs.select(
        "doc_id", F.filter(F.split(text, SPACES, -1), lambda w: w != "").alias("words"),
        symbols.cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    hashed = words.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols", "n_dup_lines",
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    return hashed.select(
        *[c for c in hashed.columns if c != "hashes"],
        _repeat_words(F.col("hashes")).cast("long").alias("n_repeat_words"),
        _buckets(F.col("hashes"), buckets).alias("grams"))


def log_ratios(counted: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row, ``ratios``: for each bucket, log p(bucket | trusted) - log p(bucket | all documents).

    ``counted`` (doc_id, grams) has every document. ``trusted`` (doc_id): at most MAX_TRUSTED rows,
    those first by hash of the id, are fitted. Both multinomials are smoothed by SMOOTHING, so every
    bucket has a finite ratio; without documents or trusted ones a multinomial is uniform.
    """
    ids = (trusted.select("doc_id").filter("doc_id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRUSTED).withColumn("is_trusted", F.lit(1)))
    counts = (counted.join(F.broadcast(ids), "doc_id", "left")
              .select("is_trusted", F.explode("grams").alias("bucket"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("n_all"), F.count("is_trusted").alias("n_trusted")))
    every = (counted.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
             .join(counts, "bucket", "left").fillna(0, ["n_all", "n_trusted"]))
    pairs = every.agg(F.array_sort(F.collect_list(F.struct("bucket", "n_all", "n_trusted"))).alias("pairs"),
                      F.sum("n_all").alias("all"), F.sum("n_trusted").alias("of_trusted"))

    def log_p(count: Column, total: str) -> Column:
        return F.log((count + SMOOTHING) / (F.col(total) + SMOOTHING * buckets))

    return pairs.select(F.transform("pairs", lambda x: log_p(x["n_trusted"], "of_trusted")
                                    - log_p(x["n_all"], "all")).alias("ratios"))


def quality(docs: DataFrame, trusted: DataFrame, min_score: float = MIN_SCORE, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the base counts, base_failed, score and kept.

    ``trusted`` (doc_id) names the documents of the target. base_failed: under MIN_WORDS words, or
    over MAX_REPEAT_PERCENT of the words repeat in five-word windows. score: mean log ratio of the
    n-grams, 0 without any, to 9 decimals. kept: not base_failed and score >= min_score, for every
    document alike. Null and empty texts have no words and fail; repeated rows each get a row; other
    columns are not read. Texts are tokenised once: their buckets are stored in the shared folder.
    """
    counted = store(base_counts(docs, buckets), "op3_counts")
    ratios = log_ratios(counted, trusted, buckets).scalar()
    total = F.aggregate("grams", F.lit(0.0), lambda a, g: a + F.get(F.col("ratios"), g))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    score = F.round(F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(F.lit(0.0)), 9)
    scored = counted.withColumn("ratios", ratios).withColumn("score", score).withColumn("base_failed", failed)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "score", (~F.col("base_failed") & (F.col("score") >= min_score)).alias("kept"))


def trusted_labels(labels: DataFrame) -> DataFrame:
    """doc_id of the rows of ``labels`` with quality 1 that aren't marked toxic."""
    return labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1)).select("doc_id")
