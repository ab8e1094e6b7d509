"""The crawl report: every result table of a set of log lines or rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.metrics import human_bytes, ratio
from linkloom.operators import report as R
from linkloom.sources import crawl_log as L
from linkloom.sources.log_sets import whole_logs


@dataclass
class Report:
    """Result tables, one set of rows per log in each."""

    summary: DataFrame
    timing: DataFrame
    discovery: DataFrame
    statuses: DataFrame
    domains: DataFrame


def report_of(rows: DataFrame, stats: DataFrame, k: int = 10) -> Report:
    """Tables over typed rows (with debug tail) and ``log, key, value`` STAT values.

    Each table prunes to the columns it needs, so keep ``rows`` as Parquet when logs are large.
    """
    overlaid = R.stat_overlay(rows, stats)
    pages = R.success(overlaid)
    summary = (
        R.summary_of(overlaid)
        .withColumn("total_size", human_bytes(F.col("total_bytes")))
        .withColumn(
            "avg_bytes", F.floor(ratio(F.col("total_bytes"), F.col("pages"))).cast("bigint")
        )
        .withColumn("avg_size", human_bytes(F.col("avg_bytes")))
    )
    return Report(
        summary=summary,
        timing=R.phase_percentiles(rows),
        discovery=R.discovery(rows),
        statuses=R.status_distribution(rows, pages, k),
        domains=R.top_domains(rows, k),
    )


def report_of_lines(lines: DataFrame, k: int = 10) -> Report:
    """Report straight from log lines ``log, ord, line``."""
    return report_of(L.log_rows_with_debug(lines), L.stat_values(lines), k)


def report_logs(
    spark: SparkSession, paths: str | list[str], summary_path: str | None = None, k: int = 10
) -> tuple[Report, DataFrame]:
    """Report of every log of ``paths`` that can be read to its end, and one row for each that cannot.

    With ``summary_path`` the run summary there gets a row for each good log, and none for the others.
    """
    logs = whole_logs(spark, paths)
    report = report_of_lines(logs.lines, k)
    if summary_path is not None:
        L.append_summary(report.summary, summary_path)
    return report, logs.failed
