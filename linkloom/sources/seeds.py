"""Seed lists: one URL per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Blanks in the sense of str.strip on text files.
_BLANK = r"\s\x1c-\x1f"


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of text files as ``file, ord, line``.

    ``ord`` orders the lines of one file: the start of the split a line was read from, then the
    row's place in its task.
    """
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"),
        F.col("value").alias("line"),
    )


def seeds(lines: DataFrame, strip_inline_comments: bool = False) -> DataFrame:
    """Seed URLs from ``ord, line``: trimmed, blanks and ``#`` lines dropped, ``ord`` kept.

    A comment after a URL stays part of it unless ``strip_inline_comments`` is set.
    """
    text = F.col("line")
    if strip_inline_comments:
        text = F.regexp_replace(text, rf"(?U)[{_BLANK}]+#.*$", "")
    url = F.regexp_replace(text, rf"(?U)^[{_BLANK}]+|[{_BLANK}]+$", "")
    return (
        lines.select("ord", url.alias("url"))
        .filter((F.col("url") != "") & ~F.col("url").startswith("#"))
    )
