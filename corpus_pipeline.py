"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, benchmark decontamination, BPE.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns the
columns of documents; the last returns doc_id, n_tokens and ids (decimal, joined by a
blank). Nulls, ties and empty tables are as in the operators.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import bpe, decontaminate, line_dedup, ngram_join, quality_rules
from lexweave.llm.common import cut, made_here, release_paths, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Tables of the stage that was called last.
_LEFT: list[str] = []


def _stage(f: Stage) -> Stage:
    """A stage deletes what the stage before has left in the shared folder: its result was written before this one begins."""

    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_paths(spark, _LEFT)
        with made_here() as made:
            out = f(spark, docs, sf_dir)
        _LEFT[:] = made
        return out

    return run


def _recount(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits go from the others."""
    return _recount(quality_rules.clean(docs))


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches go; documents stay."""
    return _recount(line_dedup.dedup_lines(docs))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component over shingles of five words at 0.8 stays."""
    return ngram_join.deduplicate(docs, k=5, percent=80)


@_stage
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with windows of two or more benchmark items go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path(bpe.NAME), decoded=False)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontaminate", benchmark),
    ("bpe", tokens),
]

#: SQL cannot express the last stage; tests/llm/test_pipeline.py holds each stage and run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
