"""Breadth-first traversal of a link table, crawl order, and a whole crawl over a page snapshot.

The driver only loops over levels; rows stay on the executors. Each level is written to the shared
folder, so a lost executor costs one level and no plan contains the levels before it. The edge
table and every large level are bucketed by URL when written: in the loop only the targets of the
current level are shuffled, neither the edges nor the visited URLs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import urls as U
from linkloom.functions.bodies import is_truncated
from linkloom.functions.metrics import is_backoff_status, is_html, novelty_priority
from linkloom.operators import frontier as fr
from linkloom.operators.links import listed, with_links
from linkloom.operators.ordering import BLOCK, numbered, running_domain_counts
from linkloom.operators.robots import decision, host_policies
from linkloom.session import STORE_ROWS, cut, own_side, settle, store
from linkloom.sources.pages import snapshot

# A source with at least 1/HOT_SHARE of all edges, and this many of them, is split over tasks.
HOT_SHARE = 200
HOT_EDGES = 1_000_000


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@dataclass
class LinkTable:
    """Edges bucketed by ``(src, _salt)``; ``hot`` maps a hot source to its number of salts.

    At most ``HOT_SHARE`` sources can each hold 1/``HOT_SHARE`` of the edges, which bounds ``hot``.
    """

    edges: DataFrame
    hot: DataFrame | None

    @staticmethod
    def of(edges: DataFrame, hot_edges: int = HOT_EDGES) -> LinkTable:
        found = cut(edges)
        degrees = found.groupBy("src").agg(F.count("*").alias("n"))
        total, most = degrees.agg(F.sum("n"), F.max("n")).first()
        limit = max(hot_edges, (total or 0) / HOT_SHARE)
        if (most or 0) < limit:
            return LinkTable(store(found.withColumn("_salt", F.lit(0)), "src", "_salt"), None)
        salts = F.ceil(F.col("n") / F.lit(limit)).cast("int").alias("salts")
        hot = cut(degrees.filter(F.col("n") >= limit).select("src", salts))
        salt = F.pmod(F.xxhash64("dst"), F.coalesce("salts", F.lit(1))).cast("int")
        salted = found.join(F.broadcast(hot), "src", "left").withColumn("_salt", salt)
        return LinkTable(store(salted.drop("salts"), "src", "_salt"), hot)

    def leaving(self, level: DataFrame) -> DataFrame:
        """Edges out of the URLs of ``level``, the level's other columns beside."""
        if self.hot is None:
            keyed = level.withColumn("_salt", F.lit(0))
        else:
            salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
            keyed = (
                level.join(F.broadcast(self.hot.withColumnRenamed("src", "url")), "url", "left")
                .withColumn("_salt", F.explode(salts))
                .drop("salts")
            )
        keyed = keyed.withColumnRenamed("url", "src")
        return keyed.join(self.edges, ["src", "_salt"]).drop("_salt")


@dataclass
class Visited:
    """Levels visited so far. Large ones are bucketed and joined one by one, where they lie; the
    small ones together."""

    large: list[DataFrame]
    small: list[DataFrame]

    @property
    def all(self) -> DataFrame:
        return _union(self.large + self.small)

    def add(self, level: DataFrame, n: int) -> None:
        (self.large if n >= STORE_ROWS else self.small).append(level)

    def without(self, targets: DataFrame) -> DataFrame:
        """Targets in no level so far."""
        rest = [_union(self.small)] if self.small else []
        return reduce(
            lambda left, level: fr.unseen(left, level, settled=True), self.large + rest, targets
        )


def bfs_depths(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int = fr.MAX_DEPTH,
    hot_edges: int = HOT_EDGES,
) -> DataFrame:
    """``url, depth`` of every URL within ``max_depth`` links of a seed, at its smallest depth."""
    table = LinkTable.of(edges.select("src", "dst"), hot_edges)

    def reached(urls: DataFrame, depth: int) -> tuple[DataFrame, int]:
        return settle(urls.select("url", F.lit(depth).alias("depth")), "url")

    visited = Visited([], [])
    level, n = reached(seeds.select("url").distinct(), 0)
    visited.add(level, n)
    for depth in range(1, max_depth + 1):
        targets = table.leaving(level.select("url")).select(F.col("dst").alias("url")).distinct()
        level, n = reached(visited.without(targets), depth)
        if n == 0:
            break
        visited.add(level, n)
    return visited.all


def enqueue_order(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int = fr.MAX_DEPTH,
    hot_edges: int = HOT_EDGES,
) -> DataFrame:
    """``url, depth, seq``: the number under which a breadth-first traversal first queues each URL.

    ``edges`` is ``src, pos, dst``, ``seeds`` is ``url, ord``. Seeds are queued in their order; a level's
    pages are taken in theirs, and each queues its new links by position. A URL's place in its level is
    the path of positions that leads to it, so a level is never numbered by itself: paths of one level
    have one length and compare as arrays, and all rows are numbered once, at the end.
    """
    table = LinkTable.of(edges.select("src", "pos", "dst"), hot_edges)

    def reached(found: DataFrame, depth: int) -> tuple[DataFrame, int]:
        path = F.concat("parent", F.array("pos"))
        return settle(found.select("url", F.lit(depth).alias("depth"), path.alias("path")), "url")

    start = seeds.groupBy("url").agg(F.min(F.col("ord").cast("bigint")).alias("pos"))
    start = start.withColumn("parent", F.array().cast("array<bigint>"))
    visited = Visited([], [])
    level, n = reached(start, 0)
    visited.add(level, n)
    for depth in range(1, max_depth + 1):
        first = (
            table.leaving(level.select("url", F.col("path").alias("parent")))
            .groupBy(F.col("dst").alias("url"))
            .agg(F.min(F.struct("parent", F.col("pos").cast("bigint").alias("pos"))).alias("first"))
            .select("url", "first.*")
        )
        level, n = reached(visited.without(first), depth)
        if n == 0:
            break
        visited.add(level, n)
    return numbered(visited.all, ["depth", "path"], "seq").select("url", "depth", "seq")


def seen_before_level(nodes: DataFrame, key: str, name: str) -> DataFrame:
    """Nodes of each ``key`` at smaller depths: ``key, depth, name``."""
    earlier = Window.partitionBy(key).orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    sizes = nodes.groupBy(key, "depth").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("bigint")
    return sizes.select(key, "depth", before.alias(name))


def crawl_order(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int = fr.MAX_DEPTH,
    max_pages: int | None = None,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Crawl rank of every reachable URL by ``(priority, depth, seq)``, ``seq`` as in ``enqueue_order``.

    A URL's priority uses the counts of its domain and superdomain at the start of its level.
    """
    domain = U.url_domain(F.col("url"))
    nodes = enqueue_order(edges, seeds, max_depth).withColumn("domain", domain)
    nodes = nodes.withColumn("superdomain", U.superdomain(F.col("domain")))
    by_domain = own_side(seen_before_level(nodes, "domain", "domain_seen"))
    by_super = own_side(seen_before_level(nodes, "superdomain", "super_seen"))
    counted = nodes.join(by_domain, ["domain", "depth"]).join(by_super, ["superdomain", "depth"])
    ranked = numbered(fr.with_priority(counted, **(weights or {})), ["priority", "depth", "seq"])
    if max_pages is not None:
        ranked = ranked.filter(F.col("rank") <= max_pages)
    return ranked.select("rank", "url", "depth", "seq", "domain", "superdomain", "priority")


@dataclass
class Counters:
    """Pages and failures per domain and pages per superdomain of the levels so far.

    A level is folded in by itself: what came before is these two tables, not the levels.
    """

    by_domain: DataFrame | None = None
    by_super: DataFrame | None = None

    def fold(self, level: DataFrame) -> Counters:
        new = level.filter("NOT refused").groupBy("domain", "superdomain").agg(
            F.count("*").alias("domain_seen"),
            F.count_if(is_backoff_status(F.col("status"))).alias("failures"),
        )
        if self.by_domain is not None:
            both = self.by_domain.unionByName(new)
            sums = [F.sum(c).alias(c) for c in ("domain_seen", "failures")]
            new = both.groupBy("domain", "superdomain").agg(*sums)
        by_domain = own_side(new)
        by_super = by_domain.groupBy("superdomain").agg(F.sum("domain_seen").alias("super_seen"))
        return Counters(by_domain, own_side(by_super))

    def attached(self, out: DataFrame, backoff: int) -> DataFrame:
        """Candidates with ``domain_seen`` and ``super_seen``; those of domains at the failure limit go."""
        zero = F.lit(0).cast("bigint")
        if self.by_domain is None:
            return out.withColumns({"domain_seen": zero, "super_seen": zero})
        return (
            out.join(self.by_domain.drop("superdomain"), "domain", "left")
            .filter(F.coalesce("failures", zero) < backoff)
            .join(self.by_super, "superdomain", "left")
            .withColumns({c: F.coalesce(c, zero) for c in ("domain_seen", "super_seen")})
            .drop("failures")
        )


@dataclass
class Crawl:
    """Outcome of a crawl: the log in crawl order, and the URLs robots rules refused."""

    log: DataFrame
    blocked: DataFrame


def _page_facts(pages: DataFrame, cap: int | None) -> DataFrame:
    """Narrow attributes of each URL; of several copies the first by ``page_id`` counts."""
    html = F.col("html")
    full = is_html(F.col("ct")) & is_truncated(html, cap)
    narrow = pages.select(
        U.canonical_url(F.col("url")).alias("url"),
        F.struct(
            "page_id",
            "status",
            "ct",
            "bytes",
            "elapsed_ms",
            (F.octet_length(html) > 0).alias("has_body"),
            full.cast("int").alias("html_truncated"),
            *([F.col("final_url")] if "final_url" in pages.columns else []),
        ).alias("page"),
    )
    return narrow.groupBy("url").agg(F.min_by("page", "page.page_id").alias("page"))


def _page_edges(pages: DataFrame, facts: DataFrame, mode: str, cap: int | None) -> DataFrame:
    """Edges of every page a crawl could parse, found in one pass over the bodies."""
    body = F.octet_length("html") > 0
    good = pages.filter((F.col("status") == 200) & is_html(F.col("ct")) & body)
    parsed = with_links(good.select("page_id", "url", "html"), mode, cap=cap)
    linked = listed(parsed, ["page_id", U.canonical_url(F.col("url")).alias("src")], "link")
    first = facts.select(F.col("url").alias("src"), F.col("page.page_id").alias("page_id"))
    return linked.join(first, ["src", "page_id"], "left_semi").select(
        "src", "pos", U.canonical_url(F.col("link")).alias("dst")
    )


def crawl(
    pages: DataFrame,
    seeds: DataFrame,
    robots: DataFrame | None,
    user_agent: str,
    max_pages: int | None = None,
    max_depth: int = fr.MAX_DEPTH,
    mode: str = "fast",
    cap: int | None = None,
    skip: DataFrame | None = None,
    backoff: int = fr.BACKOFF_FAILURES,
    on_unreachable: str = "deny",
    started_at: str = "1970-01-01 00:00:00",
    weights: dict[str, float] | None = None,
    block: int = BLOCK,
) -> Crawl:
    """Crawl a page snapshot level by level from ``seeds(ord, url)``.

    Bodies are parsed once, up front and where they lie; robots verdicts and page attributes are
    found once per URL; the loop joins narrow tables only. Within a level URLs go by
    ``(priority, parent's place, position on the page)``; counters and failures are those of the
    levels before. A URL without a page is logged with status 0. ``robots=None`` turns the robots
    rules off.

    Pages may have a ``final_url``, where a redirect led: the log then carries it (a page without one has
    its own URL there). It changes nothing else: links are resolved against the URL that was asked for,
    and the final URL is not visited by that.
    """
    pages = snapshot(pages)
    facts = cut(_page_facts(pages, cap))
    table = LinkTable.of(_page_edges(pages, facts, mode, cap))
    # Seeds are normalised when listed and again when queued.
    start = cut(seeds.select(U.canonical_url(F.col("url")).alias("url"), F.col("ord").cast("double")))
    start = start.withColumn("url", U.canonical_url(F.col("url")))
    nodes = _nodes(
        table.edges.select(F.col("dst").alias("url")).unionByName(start.select("url")),
        facts, robots, user_agent, on_unreachable, skip,
    )

    def visit(found: DataFrame, depth: int, before: Counters) -> tuple[DataFrame, int]:
        """Rows of a level from ``url, parent, pos``; ``place`` sorts a level by visiting order.

        A place is the row's priority, its parent's place and its position in one array: levels are
        compared with themselves only, so the arrays have equal length, and no level is numbered.
        """
        out = before.attached(found.join(nodes, "url").filter("allowed"), backoff)
        priority = novelty_priority(
            F.lit(depth), F.col("domain_seen"), F.col("super_seen"), **(weights or {})
        )
        out = out.withColumns({"depth": F.lit(depth), "priority": priority})
        place = F.concat(F.array("priority"), F.col("parent"), F.array(F.col("pos").cast("double")))
        drop = ("parent", "pos", "allowed", "domain_seen", "super_seen")
        return settle(out.withColumn("place", place).drop(*drop), "url")

    size = F.col("has_body").cast("int")
    parsed = fr.parse_eligible(F.col("status"), F.col("ct"), F.col("depth"), size, max_depth)
    found = start.groupBy("url").agg(F.min("ord").alias("pos"))
    found = found.withColumn("parent", F.array().cast("array<double>"))
    seen = Visited([], [])
    left, before = max_pages, Counters()
    for depth in range(max_depth + 1):
        level, size_of_level = visit(found, depth, before)
        n = level.filter("NOT refused").count()
        if left is not None and n > left:
            level, size_of_level = _within(level, left)
            n = left
        seen.add(level, size_of_level)
        left = None if left is None else left - n
        if left == 0 or n == 0 or depth == max_depth:
            break
        before = before.fold(level)
        sources = level.filter("NOT refused").filter(parsed).select("url", F.col("place").alias("parent"))
        first = (
            table.leaving(sources)
            .groupBy(F.col("dst").alias("url"))
            .agg(F.min(F.struct("parent", "pos")).alias("first"))
            .select("url", "first.*")
        )
        found = seen.without(first)

    visited = seen.all
    rows = visited.filter("NOT refused")
    ordered = numbered(rows, ["depth", "place"], "seq").withColumn("log", F.lit("crawl"))
    counted = running_domain_counts(ordered, "seq", block)
    links = _link_counts(table, nodes, visited, rows.filter(parsed), backoff)
    zero = F.lit(0).cast("bigint")
    log = counted.join(links, "url", "left").select(
        "seq",
        F.lit(started_at).cast("timestamp_ntz").alias("ts"),
        "url", "status", "bytes", "depth", "priority", "domain", "domain_count", "superdomain",
        "super_count", "elapsed_ms", "ct",
        *[zero.alias(c) for c in ("t_connect_ms", "t_read_ms", "t_parse_ms")],
        F.coalesce("links_found", zero).alias("links_found"),
        F.coalesce("links_enqueued", zero).alias("links_enqueued"),
        "html_truncated",
        *(["final_url"] if "final_url" in counted.columns else []),
    )
    return Crawl(log, visited.filter("refused").select("url", "domain", "depth"))


def _final(final_url: Column) -> Column:
    return F.coalesce(final_url, F.col("url")).alias("final_url")


def _nodes(
    urls: DataFrame,
    facts: DataFrame,
    robots: DataFrame | None,
    user_agent: str,
    on_unreachable: str,
    skip: DataFrame | None,
) -> DataFrame:
    """Everything about a URL that does not change during a crawl, once per URL."""
    domain = U.url_domain(F.col("url"))
    out = urls.distinct().join(facts, "url", "left").withColumn("domain", domain)
    allowed = ~U.has_disallowed_extension(F.col("url"))
    refused: Column = F.lit(False)
    if skip is not None:
        listed = own_side(skip.select("domain").distinct()).withColumn("_skip", F.lit(True))
        out = out.join(listed, "domain", "left")
        allowed = allowed & F.col("_skip").isNull()
    if robots is not None:
        policies = own_side(host_policies(robots, user_agent))
        out = out.join(policies.withColumnRenamed("host", "domain"), "domain", "left")
        deny_all = F.coalesce("deny_all", F.lit(on_unreachable == "deny"))
        refused = ~((F.col("domain") != "") & decision(F.col("url"), deny_all, F.col("rules")))
    rows = out.select(
        "url",
        "domain",
        U.superdomain(F.col("domain")).alias("superdomain"),
        F.coalesce("page.status", F.lit(0)).alias("status"),
        F.coalesce("page.bytes", F.lit(0).cast("bigint")).alias("bytes"),
        F.coalesce("page.ct", F.lit("")).alias("ct"),
        F.coalesce("page.elapsed_ms", F.lit(0).cast("bigint")).alias("elapsed_ms"),
        F.coalesce("page.has_body", F.lit(False)).alias("has_body"),
        F.coalesce("page.html_truncated", F.lit(0)).alias("html_truncated"),
        *([_final(F.col("page.final_url"))] if "final_url" in facts.schema["page"].dataType.names else []),
        allowed.alias("allowed"),
        refused.alias("refused"),
    )
    return store(rows, "url")


def _within(level: DataFrame, left: int) -> tuple[DataFrame, int]:
    """The part of a level up to its ``left``-th page; refused URLs up to there stay."""
    nth = numbered(level.filter("NOT refused"), ["place"], "nth")
    last = nth.filter(F.col("nth") == left).select("place").scalar()
    return settle(level.filter(F.col("place") <= last), "url")


def _link_counts(
    table: LinkTable, nodes: DataFrame, visited: DataFrame, sources: DataFrame, backoff: int
) -> DataFrame:
    """Links found and accepted per parsed page, each as of the page's own level.

    A link is accepted when the static rules allow it, its target is not visited at that level or
    before, and its host has not reached the failure limit by then.
    """
    cumulative = (
        Window.partitionBy("domain")
        .orderBy("depth")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    down_from = (
        visited.filter(~F.col("refused") & is_backoff_status(F.col("status")))
        .groupBy("domain", "depth")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(cumulative))
        .filter(F.col("upto") >= backoff)
        .groupBy("domain")
        .agg(F.min("depth").alias("down_from"))
    )
    # One row per target URL: the last level at which a link to it is still accepted.
    closing = F.least(F.col("depth"), F.col("down_from"))
    targets = (
        nodes.select("url", "domain", "allowed")
        .join(visited.select("url", "depth"), "url", "left")
        .join(down_from, "domain", "left")
        .select(F.col("url").alias("dst"), "allowed", closing.alias("closing"))
    )
    out = table.leaving(sources.select("url", F.col("depth").alias("src_depth")))
    open_still = F.coalesce(F.col("closing") > F.col("src_depth"), F.lit(True))
    return (
        out.join(targets, "dst")
        .groupBy(F.col("src").alias("url"))
        .agg(
            F.count("*").alias("links_found"),
            F.count_if(F.col("allowed") & open_still).alias("links_enqueued"),
        )
    )
