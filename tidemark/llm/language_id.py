"""Language ID by Bayesian evidence fusion.

The posterior of a record's language multiplies three kinds of evidence:

* the text: a multinomial over hashed character 1- to 3-grams per language, tempered because the
  grams of a text overlap, with a flat distribution for text in no known language;
* the declared language (markup or metadata): how often records of each language declare it, learnt
  by grouped aggregation over all records;
* the address: a prior per host, smoothed by its domain, that by its suffix, that by the whole
  corpus; a record's own vote is left out of its host's.

The text models are fitted on a bounded sample of records with a declared language. All counts behind
the other evidence cover all records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import left_join_hot, store

#: Production parameters. Sampled records a language, at the most in expectation; hash buckets of a model;
#: strength of each parent prior, in records; a posterior below MIN_CONFIDENCE is no answer.
LANGUAGES = ("en", "de", "fr", "es")
SAMPLE_RECORDS = 1_000
BUCKETS = 1 << 15
PRIOR_RECORDS = 20.0
MIN_CONFIDENCE = 0.5
UNKNOWN = "und"

_TEMPER = 1 / 3  # every character is in three grams
_CHUNK = 1 << 20
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

# One small letter, or 0, for each of the first 2**16 code points; others stand for themselves.
_FOLD = np.array([ord(c.lower()) if len(c.lower()) == 1 and c.isalpha() else 0 for c in map(chr, range(1 << 16))],
                 np.uint32)


def _letters(text: str) -> np.ndarray:
    """Folded letters of ``text``; each run of other characters is one 0, also at both ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = np.where(points < len(_FOLD), _FOLD[np.minimum(points, len(_FOLD) - 1)], points)
    folded = np.concatenate([[0], folded, [0]]).astype(np.uint64)
    return folded[np.concatenate([[True], (folded[1:] != 0) | (folded[:-1] != 0)])]


def gram_buckets(letters: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the 1-, 2- and 3-grams that end at each letter."""
    shift = np.uint64(64 - (buckets - 1).bit_length())
    ends = np.flatnonzero(letters[1:]) + 1
    one = letters[ends] * _MULTIPLIERS[0]
    two = one ^ (letters[ends - 1] + np.uint64(1)) * _MULTIPLIERS[1]
    three = two ^ (letters[np.maximum(ends - 2, 0)] + np.uint64(2)) * _MULTIPLIERS[2]
    return np.concatenate([((x * _MULTIPLIERS[0]) >> shift).astype(np.int64) for x in (one, two, three)])


def _pieces(text: str) -> Iterator[str]:
    for i in range(0, len(text), _CHUNK):
        yield text[i:i + _CHUNK]


def _count_grams(languages: tuple[str, ...], buckets: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((len(languages), buckets), np.int64)
        for batch in batches:
            for language, text in zip(batch["declared"], batch["text"], strict=True):
                for piece in _pieces(text):
                    counts[languages.index(language)] += np.bincount(gram_buckets(_letters(piece), buckets),
                                                                     minlength=buckets)
        language, bucket = np.nonzero(counts)
        yield pd.DataFrame({"language": language, "bucket": bucket, "n": counts[language, bucket]})
    return count


def fit_text_models(records: DataFrame, languages: tuple[str, ...] = LANGUAGES, sample: int = SAMPLE_RECORDS,
                    buckets: int = BUCKETS) -> np.ndarray:
    """Log probabilities, languages x buckets, from about ``sample`` records of each declared language.

    The sample is by hash of the text; what comes to the driver is languages x buckets numbers at
    most. A language without records gets the flat distribution.
    """
    known = records.filter(F.col("declared").isin(*languages) & (F.length("text") > 0))
    sizes = {r["declared"]: r["n"] for r in known.groupBy("declared").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for language, n in sizes.items():
        share = F.when(F.col("declared") == language, F.lit(min(1.0, sample / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64("text", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = np.zeros((len(languages), buckets))
    rows = (known.filter(drawn < share).select("declared", "text")
            .mapInPandas(_count_grams(tuple(languages), buckets), "language int, bucket int, n long")
            .groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas())
    counts[rows["language"], rows["bucket"]] = rows["n"]
    return np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * buckets))


def text_log_likelihoods(text: str | None, models: np.ndarray) -> tuple[int, np.ndarray]:
    """Letters in ``text``, and its tempered log likelihood under each model, relative to flat text."""
    letters, total = 0, np.zeros(len(models))
    for piece in _pieces(text or ""):
        grams = gram_buckets(_letters(piece), models.shape[1])
        letters += len(grams) // 3
        total += models[:, grams].sum(axis=1) + len(grams) * np.log(models.shape[1])
    return letters, total * _TEMPER


def _score(models: np.ndarray):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [text_log_likelihoods(text, models) for text in batch.pop("text")]
            yield batch.assign(n_letters=[n for n, _ in found], evidence=[x.tolist() for _, x in found])
    return score


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def identify(records: DataFrame, languages: tuple[str, ...] = LANGUAGES, models: np.ndarray | None = None,
             sample: int = SAMPLE_RECORDS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """id, declared, language, confidence, n_letters and rejected for every row of ``records``.

    ``records``: id, text, declared, host, domain and suffix, strings but for id. A text without
    letters, null or empty has no language: ``und``, confidence 0, rejected. So has one whose likeliest language
    is less likely than flat text, or below ``min_confidence``. A null or unknown declaration is no
    evidence; null hosts, domains or suffixes are one group each; ties go to the language listed
    first; repeated rows each get a row. Other columns are not read.
    """
    languages = tuple(languages)
    size, flat = len(languages), [0.0]
    named = records.select("id", F.coalesce("text", F.lit("")).alias("text"), "declared",
                           *[F.coalesce(c, F.lit("")).alias(c) for c in ("host", "domain", "suffix")])
    if models is None:
        models = fit_text_models(named, languages, sample)
    kinds = dict(named.dtypes)
    scored = store(named.mapInPandas(_score(models), ", ".join(
        f"{c} {kinds[c]}" for c in ("id", "declared", "host", "domain", "suffix"))
        + ", n_letters long, evidence array<double>"), "op1_evidence")
    votes = scored.filter("n_letters > 0").withColumn("vote", _softmax(F.concat("evidence", F.array(*map(F.lit, flat)))))

    def counted(group: list[str]) -> DataFrame:
        return votes.groupBy(*group).agg(F.count(F.lit(1)).cast("double").alias("n"), F.array(
            *[F.sum(F.col("vote")[i]) for i in range(size)]).alias("votes"))

    def smoothed(parent: Column, votes_: Column = F.col("votes")) -> Column:
        mass = F.aggregate(votes_, F.lit(0.0), lambda a, x: a + x) + PRIOR_RECORDS
        return F.transform(votes_, lambda x, i: (x + PRIOR_RECORDS * F.get(parent, i)) / mass)

    # Bounded by the languages: the corpus prior and how each language is declared.
    rows = votes.withColumn("declared", F.when(F.col("declared").isin(*languages), F.col("declared"))).groupBy(
        "declared").agg(F.array(*[F.sum(F.col("vote")[i]) for i in range(size)]).alias("votes")).collect()
    by_declared = {r["declared"]: np.array(r["votes"]) for r in rows}
    corpus = sum(by_declared.values(), np.ones(size))
    corpus = corpus / corpus.sum()
    confusion = np.array([by_declared.get(d, np.zeros(size)) for d in languages]) + 0.5 + 4.5 * np.eye(size)
    confusion = np.log(confusion / confusion.sum(axis=0, keepdims=True))  # [declared, language]

    prior = F.array(*map(F.lit, corpus.tolist()))
    suffixes = counted(["suffix"]).select("suffix", F.col("n").alias("n_suffix"), smoothed(prior).alias("prior"))
    domains = store(counted(["suffix", "domain"]), "op1_domains")
    n_domains = domains.count()
    suffixes = store(suffixes.join(domains.groupBy("suffix").agg(F.count(F.lit(1)).alias("n_rows")), "suffix"), "op1_suffixes")
    domains = store(left_join_hot(domains, suffixes, ["suffix"], "n_rows", n_domains)
                    .select("suffix", "domain", smoothed(F.col("prior")).alias("prior")), "op1_domain_priors")
    hosts = store(counted(["suffix", "domain", "host"]), "op1_hosts")
    n_hosts = hosts.count()
    domains = store(domains.join(hosts.groupBy("suffix", "domain").agg(F.count(F.lit(1)).alias("n_rows")),
                                 ["suffix", "domain"]), "op1_domain_sizes")
    hosts = store(left_join_hot(hosts, domains, ["suffix", "domain"], "n_rows", n_hosts)
                  .select("suffix", "domain", "host", F.col("n").cast("long").alias("n"), "votes", "prior"), "op1_host_priors")
    joined = left_join_hot(scored, hosts, ["suffix", "domain", "host"], "n", scored.count())
    others = F.transform(F.col("votes"), lambda x, i: F.greatest(x - F.get(F.col("vote"), i), F.lit(0.0)))
    confusion_of = F.lit(None).cast("array<double>")
    for i, language in enumerate(languages):
        confusion_of = F.when(F.col("declared") == language, F.array(*map(F.lit, confusion[i].tolist()))).otherwise(confusion_of)
    logs = F.transform("host_prior", lambda p, i: F.log(p) + F.get(F.col("evidence"), i)
                       + F.coalesce(F.get(confusion_of, i), F.lit(0.0)))
    posterior = (joined.withColumn("vote", _softmax(F.concat("evidence", F.array(*map(F.lit, flat)))))
                 .withColumn("host_prior", smoothed(F.col("prior"), others))
                 .withColumn("posterior", _softmax(logs)))
    best = F.array_max("posterior")
    at = F.array_position("posterior", best).cast("int")
    sure = (F.col("n_letters") > 0) & (F.get(F.col("evidence"), at - 1) > 0) & (best >= min_confidence)
    answered = posterior.withColumn("sure", F.coalesce(sure, F.lit(False)))
    return answered.select(
        "id", "declared", F.when(F.col("sure"), F.element_at(F.array(*map(F.lit, languages)), at))
        .otherwise(F.lit(UNKNOWN)).alias("language"),
        F.round(F.when(F.col("sure"), best).otherwise(F.lit(0.0)), 6).alias("confidence"),
        F.col("n_letters").cast("long").alias("n_letters"), (~F.col("sure")).alias("rejected"))


def document_records(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang, source) as records: the source is host and domain, without a suffix."""
    source = F.col("source").cast("string")
    return docs.select(F.col("doc_id").alias("id"), "text", F.lower(F.substring("lang", 1, 2)).alias("declared"),
                       source.alias("host"), source.alias("domain"), F.lit(None).cast("string").alias("suffix"))


def page_records(pages: DataFrame, text: Column) -> DataFrame:
    """``pages`` (page_id, url, html) as records: language of the html element; host, domain and suffix of the url."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    declared = F.regexp_extract("html", r"(?i)<html\b[^>]*?\s(?:xml:)?lang\s*=\s*[\"']?\s*([a-z]{2})", 1)
    return pages.select(F.col("page_id").alias("id"), text.alias("text"), F.lower(declared).alias("declared"),
                        host.alias("host"), F.substring_index(host, ".", -3).alias("domain"),
                        F.substring_index(host, ".", -1).alias("suffix"))
