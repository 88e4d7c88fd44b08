"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, language_id, line_dedup, mixing, order_minhash
from tidemark.llm.common import store, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose text is in a language that language ID knows; the others go."""
    records = language_id.document_records(docs)
    found = language_id.identify(records.withColumn("id", F.struct("id", F.xxhash64("text").alias("hash"))))
    # Written before it is filtered: a filter pushed into the posterior would evaluate it many times over.
    answers = store(found.select("id.id", "id.hash", "rejected"), "pipeline_answers")
    rejected = answers.filter("rejected").select("id", "hash").distinct()
    same = docs["doc_id"].eqNullSafe(rejected["id"]) & (F.xxhash64(docs["text"]) == rejected["hash"])
    return docs.join(rejected, same, "left_anti")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without cross-site boilerplate lines, n_chars to match."""
    done = line_dedup.line_dedup(docs)
    text = F.col("lines.cleaned")
    changed = {"text": text, "n_chars": F.coalesce(F.length(text), F.lit(0)).cast("long")}
    return done.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest doc_id. A row without a doc_id goes if
    its text has a document."""
    answers = order_minhash.near_dedup(docs)
    gone = store(answers.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
                 .distinct(), "pipeline_gone")
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & F.xxhash64(docs["text"]).eqNullSafe(gone["gone_hash"])
    return docs.join(gone, same, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the temperature mix draws them."""
    return mixing.realise(docs)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents, then token_ids (little-endian unsigned 32-bit integers), n_tokens and
    whether the ids decode to the text."""
    done = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = F.coalesce("row.text", F.lit("")).cast("binary")
    return done.select("row.*", "token_ids", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
                       (F.col("decoded") == text).alias("round_trip"))


STAGES = [
    ("language ID", keep_known_languages),
    ("line dedup", drop_boilerplate),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_bytes),
]

#: Hashed features, sketches and byte merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
