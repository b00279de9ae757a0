"""The corpus pipeline: documents without toxic ones, repeated lines and near copies, mixed and encoded.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on, in their own columns; the
last returns their piece ids. Stages are written as Parquet and read again by the next.

Edge cases, stage by stage: null and empty texts are scored as texts without a known word, have no line to
lose and link with nobody, so they reach the mixture, which takes no row without words. Rows that share a
doc_id, or have none, are documents of their own by their text. Repeated rows are scored, cut and encoded
alike; of near copies and repeats one row stays, the same whatever the partitions. Other columns, also ones
with clashing names, go through unchanged (n_chars follows the text). Empty tables give empty tables. Each
stage is tested row by row against plain Python on a table of these cases (tests/llm/test_pipeline.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import line_dedup, mixture, ngram_jaccard, pieces, toxicity
from lakeloom.llm.common import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: learned from the labelled documents; those scored 0.5 or more go."""
    return toxicity.keep_clean(docs, toxicity.learn_from(spark, sf_dir, docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines in windows that occurred before go, and documents of which nothing is left."""
    return line_dedup.clean(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of documents linked by five-word shingles at a similarity of 0.8, the first stays."""
    return ngram_jaccard.keep_one(docs, 5, 80, 100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: each source in its target share, repeated up to three times or cut."""
    return mixture.take_texts(docs, mixture.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: sampled piece ids of each text."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_copies", drop_near_copies),
    ("mixture", mix_sources),
    ("sentencepiece", encode),
]

#: SQL can't express a learned classifier or sampled segmentations; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a directory."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
