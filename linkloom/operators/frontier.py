"""Frontier predicates and order over tables of candidate URLs.

Lookup tables (visited URLs, blocked or skipped domains, counters) grow with the crawl, so none is
broadcast by hint: adaptive execution broadcasts a side it has measured to be small and otherwise
splits the partitions of a hot host in a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.metrics import (
    HTML_PREFIX,
    is_backoff_status,
    is_html,
    novelty_priority,
)
from linkloom.operators.ordering import numbered
from linkloom.session import own_side

# The depth of a crawl and the failure count that blocks a domain.
MAX_DEPTH = 10
BACKOFF_FAILURES = 5


def not_skipped(candidates: DataFrame, skip: DataFrame, domain: str = "domain") -> DataFrame:
    """Candidates whose host is not on the skip list (exact host)."""
    return candidates.join(own_side(skip.select(domain).distinct()), domain, "left_anti")


def failing_domains(
    rows: DataFrame, threshold: int = BACKOFF_FAILURES, domain: str = "domain"
) -> DataFrame:
    """Domains with at least ``threshold`` rows whose status counts against them."""
    failures = rows.groupBy(domain).agg(
        F.count_if(is_backoff_status(F.col("status"))).alias("failures")
    )
    return failures.filter(F.col("failures") >= threshold)


def not_failing(candidates: DataFrame, failing: DataFrame, domain: str = "domain") -> DataFrame:
    return candidates.join(own_side(failing.select(domain)), domain, "left_anti")


def _lookup(visited: DataFrame, url: str, settled: bool) -> DataFrame:
    """Visited URLs as a side of their own, so that the rows of a hot URL can be split."""
    urls = visited.select(url)
    return urls if settled else own_side(urls.distinct())


def unseen(
    candidates: DataFrame, visited: DataFrame, url: str = "url", settled: bool = False
) -> DataFrame:
    """Candidates that were not visited. ``settled``: ``visited`` was materialised by the caller."""
    return candidates.join(_lookup(visited, url, settled), url, "left_anti")


def seen(
    candidates: DataFrame, visited: DataFrame, url: str = "url", settled: bool = False
) -> DataFrame:
    return candidates.join(_lookup(visited, url, settled), url, "left_semi")


def mark_accepted(
    edges: DataFrame, visited: DataFrame, failing: DataFrame, allowed: Column, url: str = "dst"
) -> DataFrame:
    """Edges with ``accepted``: ``allowed`` (extension and skip rules), not visited, host not failing.

    Needs a ``domain`` column, the host of ``url``.
    """
    known = _lookup(visited, "url", settled=False).withColumnRenamed("url", url)
    seen_urls = known.withColumn("_seen", F.lit(True))
    down = own_side(failing.select("domain")).withColumn("_down", F.lit(True))
    return (
        edges.join(seen_urls, url, "left")
        .join(down, "domain", "left")
        .withColumn("accepted", allowed & F.col("_seen").isNull() & F.col("_down").isNull())
        .drop("_seen", "_down")
    )


def parse_eligible(
    status: Column,
    content_type: Column,
    depth: Column,
    size: Column,
    max_depth: int = MAX_DEPTH,
    prefix: str = HTML_PREFIX,
) -> Column:
    """A good HTML page with a body, above the depth limit."""
    return (status == 200) & is_html(content_type, prefix) & (depth < max_depth) & (size > 0)


def attach_counts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Current page counts of each candidate's domain and superdomain, 0 when not seen yet.

    ``counts`` is ``domain, superdomain, n``; each row of it is one domain.
    """
    by_super = own_side(counts.groupBy("superdomain").agg(F.sum("n").alias("super_seen")))
    by_domain = own_side(counts.groupBy("domain").agg(F.sum("n").alias("domain_seen")))
    zero = F.lit(0).cast("bigint")
    return (
        candidates.join(by_domain, "domain", "left")
        .join(by_super, "superdomain", "left")
        .withColumns(
            {
                "domain_seen": F.coalesce("domain_seen", zero).cast("bigint"),
                "super_seen": F.coalesce("super_seen", zero).cast("bigint"),
            }
        )
    )


def with_priority(candidates: DataFrame, **weights: float) -> DataFrame:
    """Add ``priority`` from depth and the attached counts; smaller goes first."""
    return candidates.withColumn(
        "priority",
        novelty_priority(F.col("depth"), F.col("domain_seen"), F.col("super_seen"), **weights),
    )


def first_per_url(frontier: DataFrame, url: str = "url") -> DataFrame:
    """One row per URL: the one that would leave the queue first.

    A minimum over ``(priority, depth, seq)`` rather than a ranked window: copies of a URL shrink to
    one row per task before they are shuffled.
    """
    best = F.min(F.struct("priority", "depth", "seq")).alias("best")
    return frontier.groupBy(url).agg(best).select(url, "best.priority", "best.depth", "best.seq")


def frontier_order(frontier: DataFrame, name: str = "rank") -> DataFrame:
    """Number the frontier by ``(priority, depth, seq)``."""
    return numbered(frontier, ["priority", "depth", "seq"], name)


def page_budget(frontier: DataFrame, max_pages: int, keys: list[str] | None = None) -> DataFrame:
    """The first ``max_pages`` rows of the frontier, exactly, with their rank.

    The cut is made on the distributed numbering, so a budget of any size passes through no single
    task.
    """
    ranked = numbered(frontier, keys or ["priority", "depth", "seq"])
    return ranked.filter(F.col("rank") <= max_pages)
