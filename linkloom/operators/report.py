"""Crawl statistics over log rows. Every figure is kept per ``log``.

All group-bys are hash aggregations with map-side partials, so a log or domain that holds most rows
sends one partial row per task, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.metrics import at_least_zero, is_backoff_status, percent, ratio

PHASES = ("t_connect_ms", "t_read_ms", "t_parse_ms")


def _sum(x: Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0)).cast("bigint")


def totals(rows: DataFrame) -> DataFrame:
    """Rows, bytes, elapsed time and their means per log; the byte mean is truncated."""
    return rows.groupBy("log").agg(
        F.count("*").alias("pages"),
        _sum(at_least_zero(F.col("bytes"))).alias("total_bytes"),
        _sum(at_least_zero(F.col("elapsed_ms"))).alias("total_elapsed_ms"),
        F.avg(at_least_zero(F.col("elapsed_ms"))).alias("avg_elapsed_ms"),
        F.floor(F.avg(at_least_zero(F.col("bytes")))).cast("bigint").alias("avg_bytes"),
    )


def crawl_stats(rows: DataFrame) -> DataFrame:
    """Run totals as the crawler reports them: pages, bytes, seconds, pages/s, 404s and 403s."""
    span = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")) / F.lit(1e6)
    return (
        rows.groupBy("log")
        .agg(
            F.count("*").alias("pages_crawled"),
            _sum(at_least_zero(F.col("bytes"))).alias("total_bytes"),
            span.alias("elapsed_sec"),
            F.count_if(F.col("status") == 404).alias("num_404"),
            F.count_if(F.col("status") == 403).alias("num_403"),
        )
        .withColumn("rate_pages_per_sec", ratio(F.col("pages_crawled"), F.col("elapsed_sec")))
    )


def stat_overlay(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Totals with the log's own STAT values put first where they are numbers.

    Without a usable STAT value pages and bytes come from the rows, the others are 0. ``stats`` is
    ``log, key, value`` with one row per key.
    """
    given = (
        stats.withColumn("number", F.col("value").try_cast("double"))
        .groupBy("log")
        .pivot("key", ["pages_crawled", "total_bytes", "elapsed_sec", "rate_pages_per_sec",
                       "num_404", "num_403"])
        .agg(F.first("number"))
    )
    base = rows.groupBy("log").agg(
        F.count("*").alias("row_pages"),
        _sum(at_least_zero(F.col("bytes"))).alias("row_bytes"),
        F.avg(at_least_zero(F.col("elapsed_ms"))).alias("avg_elapsed_ms"),
        F.count_if(F.col("status").cast("string") == "200").alias("total_success"),
    )

    def whole(key: str, default: Column) -> Column:
        return F.coalesce(F.col(key).try_cast("bigint"), default).alias(key)

    def real(key: str) -> Column:
        return F.coalesce(F.col(key), F.lit(0.0)).alias(key)

    none = F.lit(0).cast("bigint")
    joined = base.join(given, "log", "full")
    return joined.select(
        "log",
        whole("pages_crawled", F.coalesce("row_pages", none)),
        whole("total_bytes", F.coalesce("row_bytes", none)),
        real("elapsed_sec"),
        real("rate_pages_per_sec"),
        whole("num_404", none),
        whole("num_403", none),
        F.coalesce("row_pages", none).alias("row_pages"),
        F.coalesce("total_success", none).alias("total_success"),
        F.coalesce("avg_elapsed_ms", F.lit(0.0)).alias("avg_elapsed_ms"),
    )


def success(overlaid: DataFrame, keep: tuple[str, ...] | list[str] = ("log",)) -> DataFrame:
    """Success and failure counts; the total is the STAT page count, or the row count if that is 0.

    ``keep`` names columns of the overlay to have beside.
    """
    total = F.when(F.col("pages_crawled") != 0, F.col("pages_crawled")).otherwise(
        F.col("row_pages")
    )
    return overlaid.select(
        *[c for c in keep if c not in ("pages", "total_success")],
        total.alias("pages"),
        "total_success",
        at_least_zero(total - F.col("total_success")).alias("total_failure"),
        percent(F.col("total_success"), total).alias("success_rate_pct"),
    )


def recomputed_rate(rows: DataFrame) -> DataFrame:
    """1000 / mean latency: the pages per second of one worker, not of the whole run."""
    mean = F.avg(at_least_zero(F.col("elapsed_ms")))
    return rows.groupBy("log").agg(
        mean.alias("avg_elapsed_ms"), ratio(F.lit(1000), mean).alias("rate_recomputed")
    )


def _top(counts: DataFrame, key: str, n: str, k: int) -> DataFrame:
    """The ``k`` largest rows per log, ties by key; each task cuts to ``k`` before the shuffle."""
    w = Window.partitionBy("log").orderBy(F.desc(n), F.asc(key))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def status_distribution(rows: DataFrame, pages: DataFrame, k: int = 10) -> DataFrame:
    """Top statuses per log with their share of the log's pages (``log, pages``)."""
    counts = rows.groupBy("log", "status").agg(F.count("*").alias("n"))
    return (
        _top(counts, "status", "n", k)
        .join(pages.select("log", "pages"), "log", "left")
        .select("log", "rank", "status", "n", percent(F.col("n"), F.col("pages")).alias("share_pct"))
    )


def top_domains(rows: DataFrame, k: int = 10) -> DataFrame:
    """Domains with most pages per log; rows without a domain do not count."""
    counts = (
        rows.filter(F.col("domain") != "").groupBy("log", "domain").agg(F.count("*").alias("n"))
    )
    return _top(counts, "domain", "n", k).select("log", "rank", "domain", "n")


def phase_histogram(rows: DataFrame) -> DataFrame:
    """Rows per log, phase and millisecond value, from rows whose debug tail is good."""
    pairs = ", ".join(f"'{p}', {p}" for p in PHASES)
    long = rows.filter("debug_ok").select(
        "log", F.expr(f"stack({len(PHASES)}, {pairs}) AS (phase, value)")
    )
    return long.groupBy("log", "phase", "value").agg(F.count("*").alias("n"))


def phase_percentiles(rows: DataFrame) -> DataFrame:
    """Median and 95th percentile per log and phase, both truncated to whole milliseconds.

    The 95th is the exclusive kind: with n values sorted it lies at 95(n+1)/100 between the
    neighbours, extrapolating at the ends. Ranks are looked up in the histogram's running count, so
    the ordered pass sees distinct values only.
    """
    group = Window.partitionBy("log", "phase")
    running = group.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = phase_histogram(rows).select(
        "log",
        "phase",
        "value",
        F.sum("n").over(running).alias("upto"),
        F.sum("n").over(group).alias("total"),
    )
    n = F.col("total")
    j = F.least(F.greatest(F.expr("(95 * (total + 1)) div 100"), F.lit(1)), n - 1)

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("upto") >= rank, F.col("value")))

    picked = ranked.groupBy("log", "phase").agg(
        F.max("total").alias("total"),
        at(F.expr("(total + 1) div 2")).alias("low"),
        at(F.expr("total div 2 + 1")).alias("high"),
        at(j).alias("x0"),
        at(j + 1).alias("x1"),
        F.max("value").alias("top"),
    )
    share = 95 * (n + 1) - 100 * j
    return picked.select(
        "log",
        "phase",
        F.expr("(low + high) div 2").alias("p50"),
        F.when(n > 1, F.floor((F.col("x0") * (100 - share) + F.col("x1") * share) / 100))
        .otherwise(F.col("top"))
        .cast("bigint")
        .alias("p95"),
    )


def discovery(rows: DataFrame) -> DataFrame:
    """Links found and enqueued, pages that hit the byte cap, and their share of debug rows."""
    hits = F.count_if(F.col("html_truncated") != 0)
    return (
        rows.filter("debug_ok")
        .groupBy("log")
        .agg(
            F.count("*").alias("debug_rows"),
            _sum(F.col("links_found")).alias("links_found"),
            _sum(F.col("links_enqueued")).alias("links_enqueued"),
            hits.alias("truncated"),
            percent(hits, F.count("*")).alias("truncated_pct"),
        )
    )


def run_summary(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """One row of eleven figures per log: STAT values first, rates rounded as they are published."""
    return summary_of(stat_overlay(rows, stats))


def summary_of(overlaid: DataFrame) -> DataFrame:
    """``run_summary`` of an overlay that is at hand already."""
    return success(overlaid, keep=overlaid.columns).select(
        "log",
        "pages",
        "total_success",
        "total_failure",
        F.round("success_rate_pct", 2).alias("success_rate_pct"),
        "total_bytes",
        F.round("elapsed_sec", 3).alias("elapsed_sec"),
        F.round("rate_pages_per_sec", 2).alias("rate_official"),
        F.round(ratio(F.lit(1000), F.col("avg_elapsed_ms")), 2).alias("rate_recomputed"),
        "num_404",
        "num_403",
    )


def quick_statistics(rows: DataFrame, k: int = 10) -> DataFrame:
    """Small statistics of leniently read rows: totals repeated beside the top statuses."""
    base = totals(rows).select("log", "pages", "total_bytes", "avg_elapsed_ms")
    return status_distribution(rows, base, k).join(base, "log").select(
        "log", "pages", "total_bytes", "avg_elapsed_ms",
        ratio(F.lit(1000), F.col("avg_elapsed_ms")).alias("rate_recomputed"),
        "rank", "status", "n",
    )


def domain_counts(rows: DataFrame) -> DataFrame:
    """Pages per domain with the pages of its superdomain beside."""
    by_domain = rows.groupBy("log", "superdomain", "domain").agg(F.count("*").alias("domain_count"))
    by_super = by_domain.groupBy("log", "superdomain").agg(
        F.sum("domain_count").alias("super_count")
    )
    return by_domain.join(by_super, ["log", "superdomain"])


def status_class(status: Column) -> Column:
    """What a status means to the crawl: success, not_found, forbidden, backoff or other."""
    return (
        F.when(status == 200, "success")
        .when(status == 404, "not_found")
        .when(status == 403, "forbidden")
        .when(is_backoff_status(status), "backoff")
        .otherwise("other")
    )


def status_classes(rows: DataFrame) -> DataFrame:
    """Rows per log and status class, and how many of them count against their domain."""
    return (
        rows.withColumn("class", status_class(F.col("status")))
        .groupBy("log", "class")
        .agg(
            F.count("*").alias("n"),
            F.count_if(is_backoff_status(F.col("status"))).alias("n_backoff"),
        )
    )
