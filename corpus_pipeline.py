"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next.

Low-quality documents go, lines that repeat earlier ones go, one document of each group of
near duplicates stays, sources are mixed towards even weights, and what is left is packed into
sequences. Every stage works on all rows of the one before and on whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import ready, table, written
from linkloom.llm.line_dedup import repeated_lines, without_lines
from linkloom.llm.mixing import Target, mixed
from linkloom.llm.near_dedup import near_duplicates
from linkloom.llm.packing import packed
from linkloom.llm.quality import good_documents

#: No source is drawn more than twice as often as the largest, which is drawn once: nothing is left out.
MIX = Target(repeats=2.0, seed="corpus")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return good_documents(docs, table(ready(spark), sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; a text with no other line goes."""
    ready(spark)
    return without_lines(docs, repeated_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): the smallest ``doc_id``.

    Rows of one id are one document and stay or go together.
    """
    ready(spark)
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source is drawn."""
    ready(spark)
    return mixed(docs, MIX).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    ready(spark)
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

#: The line, near-duplicate and classifier stages have no SQL form; tests hold ``run`` against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    name, stage = STAGES[-1]
    return written(stage(spark, docs, sf_dir), name)
