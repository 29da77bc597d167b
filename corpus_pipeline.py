"""A training corpus from raw documents: STAGES in order, each written as Parquet and reread.

Every stage but the last returns the columns of ``documents``; n_chars follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphload.llm import bpe, language, mixing, ngramjoin, passages
from graphload.llm.common import table, word_count
from graphload.storage import write_once

# Near copies: word shingles of five words, a similarity of 0.8.
SHINGLE = 5
PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, learned from these documents, accepts."""
    model = language.train(docs.select("doc_id", "text", "lang"), F.lit(True))
    judged = language.predict(docs, model, docs.columns)
    return judged.filter(~F.col("rejected")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return ngramjoin.one_of_each(docs, SHINGLE, PERCENT)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; those left empty go."""
    cleaned = passages.dedup_passages(docs)
    emptied = (F.size("removed") > 0) & (word_count(F.col("text")) == 0)
    return cleaned.filter(~emptied).select(
        *[F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as counts and digests, and of what they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id", "source"])


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# Language identification and byte-level BPE have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name=name)
    return STAGES[-1][1](spark, docs, sf_dir)
