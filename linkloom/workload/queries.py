"""Registered queries: one per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import bodies as B
from linkloom.functions import metrics as M
from linkloom.functions import urls as U
from linkloom.operators import frontier as fr
from linkloom.operators import links as K
from linkloom.operators import ordering as O
from linkloom.operators import report as R
from linkloom.operators import robots as RB
from linkloom.plans import report as PR
from linkloom.plans import traverse as T
from linkloom.session import cut, fresh_path, tune
from linkloom.sources import crawl_log as L
from linkloom.sources import log_sets as LS
from linkloom.sources import pages as P
from linkloom.sources import seeds as S
from linkloom.streaming import live
from linkloom.workload import derive as D

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}

# Small enough that the running totals below cross several ranges at every scale.
BLOCK = 500


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(tune(spark), sf)

    run.__doc__ = fn.__doc__
    _ALL[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_ALL)


def _r6(name: str):
    return F.round(name, 6).alias(name)


# -- sources ---------------------------------------------------------------------------------


@query
def seed_source(spark, sf):
    return S.seeds(D.seed_lines(spark, sf))


@query
def page_snapshot(spark, sf):
    return P.snapshot(D.pages(spark, sf)).drop("html")


@query
def snapshot_lookup(spark, sf):
    known = D.pages(spark, sf).withColumn("url", U.canonical_url(F.col("url")))
    return P.lookup(D.candidates(spark, sf).select("event_id", "url"), P.snapshot(known))


@query
def log_source(spark, sf):
    return L.log_rows(D.raw_log(spark, sf)).select(
        "log", "ord", M.log_time(F.col("ts")).alias("ts"), "url", "status", "bytes", "depth",
        _r6("priority"), "domain", "domain_count", "superdomain", "super_count", "elapsed_ms",
    )


@query
def log_debug_tail(spark, sf):
    return L.log_rows_with_debug(D.raw_log(spark, sf)).select(
        "log", "ord", "bytes", "debug_ok", *L.DEBUG_COLUMNS[1:]
    )


@query
def stat_source(spark, sf):
    return L.stat_values(D.raw_log(spark, sf))


@query
def log_source_lenient(spark, sf):
    rows = L.log_rows_lenient(D.raw_log(spark, sf))
    return rows.select("log", "ord", "status", "bytes", "elapsed_ms")


@query
def multi_log_source(spark, sf):
    path = fresh_path(spark, "logs")
    L.write_log(D.counted_log(spark, sf, BLOCK), path)
    runs = [f"{path}/log=run{i}" for i in range(3)]
    lines, skipped = L.log_lines(spark, [*runs, f"{path}/log=none"])
    return (
        L.log_rows_with_debug(lines)
        .groupBy("log")
        .agg(
            F.count("*").alias("n_rows"),
            F.sum("bytes").alias("total_bytes"),
            F.count_if("debug_ok").alias("debug_rows"),
            F.lit(len(skipped)).cast("bigint").alias("skipped"),
        )
    )


@query
def failed_logs(spark, sf):
    return LS.log_states(LS.whole_logs(spark, D.damaged_logs(spark, sf, BLOCK)))


@query
def row_quality(spark, sf):
    return L.row_quality(D.raw_log(spark, sf))


# -- sinks -----------------------------------------------------------------------------------


@query
def log_roundtrip(spark, sf):
    path = fresh_path(spark, "log")
    rows = D.counted_log(spark, sf, BLOCK).fillna(
        {"ct": "", "t_connect_ms": 0, "t_read_ms": 0, "t_parse_ms": 0, "links_found": 0,
         "links_enqueued": 0, "html_truncated": 0}
    )
    L.write_log(rows, path)
    lines, _ = L.log_lines(spark, path)
    return L.log_rows_with_debug(lines).select(
        "log", M.log_time(F.col("ts")).alias("ts"), "url", "status", "bytes", "depth",
        _r6("priority"), "domain", "domain_count", "superdomain", "super_count", "elapsed_ms",
        *L.DEBUG_COLUMNS[1:],
    )


@query
def stat_rows(spark, sf):
    return L.stat_rows(R.crawl_stats(D.crawl_log(spark, sf)))


@query
def run_summary_append(spark, sf):
    path = fresh_path(spark, "summary")
    summary = _summary(spark, sf)
    L.append_summary(summary, path)
    L.append_summary(summary, path)
    return L.read_summary(spark, path)


# -- links and URLs --------------------------------------------------------------------------


@query
def extract_links(spark, sf):
    return K.extract_links(D.parse_pages(spark, sf), mode="robust")


@query
def extract_links_fast(spark, sf):
    return K.extract_links(D.parse_pages(spark, sf), mode="fast")


@query
def extract_links_auto(spark, sf):
    return K.extract_links(D.parse_pages(spark, sf), mode="auto")


@query
def navigable_hrefs(spark, sf):
    return D.href_variants(spark, sf).filter(U.is_navigable(F.col("href")))


@query
def http_only(spark, sf):
    href = F.col("href")
    return D.href_variants(spark, sf).select(
        "page_id", "pos", U.is_web(href).alias("by_scheme"), U.is_web_literal(href).alias("literal")
    )


@query
def resolve_links(spark, sf):
    return K.page_hrefs(D.parse_pages(spark, sf))


@query
def defragment(spark, sf):
    return D.url_variants(spark, sf).withColumn("url", U.defragment(F.col("raw")))


@query
def dedupe_links(spark, sf):
    return _deduped(D.parse_pages(spark, sf))


def _deduped(pages):
    parsed = K.with_links(pages.select("page_id", "url", "html"), "robust", hrefs=True)
    hrefs = F.transform("hrefs", lambda h: h["href"])
    kept = K.distinct_in_order(hrefs)
    return parsed.select(
        "page_id",
        F.size(hrefs).cast("bigint").alias("n_links"),
        F.size(kept).cast("bigint").alias("n_distinct"),
        F.array_join(kept, " ").alias("links"),
    )


@query
def damaged_links(spark, sf):
    return K.extract_links(D.damaged_pages(spark, sf), mode="robust")


@query
def damaged_links_fast(spark, sf):
    return K.extract_links(D.damaged_pages(spark, sf), mode="fast")


@query
def damaged_links_auto(spark, sf):
    return K.extract_links(D.damaged_pages(spark, sf), mode="auto")


@query
def damaged_hrefs(spark, sf):
    return K.page_hrefs(D.damaged_pages(spark, sf))


@query
def damaged_dedupe(spark, sf):
    return _deduped(D.damaged_pages(spark, sf))


@query
def decode_html(spark, sf):
    damaged = F.concat(F.col("html").cast("binary"), F.unhex(F.lit("FFC328")))
    text = B.decode_lenient(damaged)
    return D.pages(spark, sf).select(
        "page_id", F.length(text).cast("bigint").alias("n_chars"), F.md5(text).alias("digest")
    )


@query
def html_cap(spark, sf):
    kept = B.capped(F.col("html"), 4096)
    return D.pages(spark, sf).select(
        "page_id",
        F.octet_length(kept).cast("bigint").alias("bytes_kept"),
        F.octet_length("html").cast("bigint").alias("bytes"),
        B.is_truncated(F.col("html"), 4096).alias("html_truncated"),
    )


@query
def body_policy(spark, sf):
    p = F.col("page_id")
    ct = F.when(p % 4 < 2, "text/html; charset=utf-8").when(p % 4 == 2, "application/json")
    kept = B.kept_body(F.col("html"), ct.otherwise(""), 8192)
    return D.pages(spark, sf).select(
        "page_id", F.octet_length(kept).cast("bigint").alias("bytes_kept")
    )


@query
def canonicalize_urls(spark, sf):
    return D.url_variants(spark, sf).withColumn("url", U.canonical_url(F.col("raw")))


@query
def url_domains(spark, sf):
    domain = U.url_domain(U.canonical_url(F.col("raw")))
    return D.url_variants(spark, sf).select("page_id", domain.alias("domain"))


@query
def url_superdomains(spark, sf):
    domain = U.url_domain(U.canonical_url(F.col("raw")))
    return D.url_variants(spark, sf).select("page_id", U.superdomain(domain).alias("superdomain"))


@query
def url_parts(spark, sf):
    return D.url_variants(spark, sf).select(
        "page_id", U.url_parts(F.col("raw")).alias("p")
    ).select("page_id", "p.*")


@query
def link_edges(spark, sf):
    edges = K.link_edges(D.parse_pages(spark, sf).withColumn("depth", F.lit(0)), depth="depth")
    return edges.withColumn("pos", F.col("pos").cast("bigint"))


@query
def page_link_counts(spark, sf):
    edges = K.link_edges(D.parse_pages(spark, sf)).withColumn("domain", U.url_domain(F.col("dst")))
    visited = D.pages(spark, sf).select(U.canonical_url(F.col("url")).alias("url")).distinct()
    failing = fr.failing_domains(D.visits(spark, sf), 30)
    rules = ~U.has_disallowed_extension(F.col("dst"))
    return K.page_link_counts(fr.mark_accepted(edges, visited, failing, rules))


@query
def superdomain_links(spark, sf):
    """Pages and links per superdomain, from the bodies."""
    pages = K.with_links(D.parse_pages(spark, sf).select("page_id", "url", "html"), "fast")
    host = U.url_domain(U.canonical_url(F.col("url")))
    return (
        pages.select(U.superdomain(host).alias("superdomain"), F.size("links").alias("n"))
        .groupBy("superdomain")
        .agg(F.count("*").alias("pages"), F.sum("n").alias("links"))
    )


# -- frontier --------------------------------------------------------------------------------


@query
def ext_filter(spark, sf):
    urls = D.url_variants(spark, sf, with_suffix=True).select(
        "page_id", U.canonical_url(F.col("raw")).alias("url")
    )
    return urls.filter(~U.has_disallowed_extension(F.col("url")))


@query
def skip_domains(spark, sf):
    out = fr.not_skipped(D.candidates(spark, sf), D.skip_hosts(spark, sf))
    return out.select("event_id", "url", "domain")


@query
def domain_backoff(spark, sf):
    """Candidates left at two failure limits; the failures of all domains are counted once."""
    rows, cands = D.stored_log(spark, sf), cut(D.candidates(spark, sf))
    parts = [
        fr.not_failing(cands, fr.failing_domains(rows, limit)).select(
            F.lit(limit).cast("bigint").alias("threshold"), "event_id", "domain"
        )
        for limit in (5, 30)
    ]
    return parts[0].unionByName(parts[1])


def _first_links(spark, sf):
    """URLs the graph's pages link to first, as a visited set."""
    return D.graph_edges(spark, sf).filter("pos = 0").select(F.col("dst").alias("url")).distinct()


@query
def visited_filter(spark, sf):
    links = D.graph_edges(spark, sf).select("src", "pos", F.col("dst").alias("url"))
    return fr.unseen(links, _first_links(spark, sf)).select("src", "pos", "url")


@query
def seen_urls(spark, sf):
    links = D.graph_edges(spark, sf).select("src", "pos", F.col("dst").alias("url"))
    return fr.seen(links, _first_links(spark, sf)).select("src", "pos", "url")


@query
def parse_eligible(spark, sf):
    known = D.pages(spark, sf).withColumn("url", U.canonical_url(F.col("url")))
    cands = cut(D.candidates(spark, sf))
    hits = P.lookup(cands.select("event_id", "url", "depth"), P.snapshot(known)).drop("ct")
    rows = hits.join(cands.select("event_id", "ct"), "event_id")
    ok = fr.parse_eligible(F.col("status"), F.col("ct"), F.col("depth"), F.col("bytes"))
    return rows.filter(ok).select("event_id", "url", "depth")


@query
def attach_counts(spark, sf):
    counts = D.visits(spark, sf).groupBy("domain", "superdomain").agg(F.count("*").alias("n"))
    return fr.attach_counts(D.candidates(spark, sf), counts).select(
        "event_id", "domain_seen", "super_seen"
    )


@query
def novelty_priority(spark, sf):
    rows = D.stored_log(spark, sf)
    counts = rows.groupBy("domain", "superdomain").agg(F.count("*").alias("n"))
    ranked = fr.with_priority(fr.attach_counts(rows.drop("priority"), counts))
    return ranked.select("seq", F.round("priority", 9).alias("priority"))


@query
def frontier_dedupe(spark, sf):
    return fr.first_per_url(D.queue_items(spark, sf)).select("url", _r6("priority"), "depth", "seq")


@query
def frontier_order(spark, sf):
    out = fr.frontier_order(D.queue_items(spark, sf))
    return out.select("rank", "url", _r6("priority"), "depth", "seq")


@query
def page_budget(spark, sf):
    out = fr.page_budget(fr.first_per_url(D.queue_items(spark, sf)), 100)
    return out.select("rank", "url", _r6("priority"), "depth", "seq")


# -- robots ----------------------------------------------------------------------------------


@query
def robots_rules(spark, sf):
    return RB.robots_rules(D.robots(spark, sf))


@query
def robots_filter(spark, sf):
    urls = D.pages(spark, sf).select("page_id", U.canonical_url(F.col("url")).alias("url"))
    urls = urls.withColumn("domain", U.url_domain(F.col("url")))
    both = RB.robots_verdicts(urls, D.robots(spark, sf), D.USER_AGENT)
    return both.select("page_id", "url", "if_deny", "if_allow")


@query
def robots_copies(spark, sf):
    urls = D.pages(spark, sf).select("page_id", U.canonical_url(F.col("url")).alias("url"))
    urls = urls.withColumn("domain", U.url_domain(F.col("url")))
    both = RB.robots_verdicts(urls, D.robots_copies(spark, sf), D.USER_AGENT)
    return both.select("page_id", "url", "if_deny", "if_allow")


# -- traversal -------------------------------------------------------------------------------


@query
def bfs_depths(spark, sf):
    out = T.bfs_depths(D.graph_edges(spark, sf), D.graph_seed(spark, sf), max_depth=10)
    return out.select("url", F.col("depth").cast("bigint").alias("depth"))


@query
def crawl_order(spark, sf):
    out = T.crawl_order(D.graph_edges(spark, sf), D.graph_seed(spark, sf), max_depth=10)
    return out.select(
        "rank", "url", F.col("depth").cast("bigint").alias("depth"),
        F.round("priority", 9).alias("priority"),
    )


@query
def enqueue_order(spark, sf):
    out = T.enqueue_order(D.graph_edges(spark, sf), D.graph_seed(spark, sf), max_depth=10)
    return out.withColumn("depth", F.col("depth").cast("bigint"))


def _crawled(spark, sf):
    return T.crawl(
        D.graph_snapshot(spark, sf),
        D.graph_seed(spark, sf),
        D.graph_robots(spark, sf),
        D.USER_AGENT,
        max_depth=10,
        block=BLOCK,
    )


@query
def crawl_snapshot(spark, sf):
    return _crawled(spark, sf).log.drop("ts").withColumn("priority", F.round("priority", 9))


@query
def crawl_blocked(spark, sf):
    return _crawled(spark, sf).blocked


@query
def redirects(spark, sf):
    pages = D.redirected_pages(spark, sf)
    urls = pages.select("page_id", U.canonical_url(F.col("url")).alias("url"))
    return P.with_final_url(urls, P.redirects(pages)).select("page_id", "url", "final_url")


# -- statistics ------------------------------------------------------------------------------


@query
def log_totals(spark, sf):
    return R.totals(D.crawl_log(spark, sf)).withColumn("avg_elapsed_ms", _r6("avg_elapsed_ms"))


@query
def crawl_stats(spark, sf):
    out = R.crawl_stats(D.crawl_log(spark, sf))
    return out.withColumns({c: _r6(c) for c in ("elapsed_sec", "rate_pages_per_sec")})


@query
def stat_overlay(spark, sf):
    lines = D.raw_log(spark, sf)
    out = R.stat_overlay(L.log_rows(lines), L.stat_values(lines))
    return out.withColumns({c: _r6(c) for c in ("elapsed_sec", "rate_pages_per_sec", "avg_elapsed_ms")})


def _overlaid(spark, sf):
    rows = D.stored_log(spark, sf)
    return rows, L.stat_rows(R.crawl_stats(rows))


@query
def success_rate(spark, sf):
    out = R.success(R.stat_overlay(*_overlaid(spark, sf)))
    return out.withColumn("success_rate_pct", _r6("success_rate_pct"))


@query
def recomputed_rate(spark, sf):
    out = R.recomputed_rate(D.crawl_log(spark, sf))
    return out.withColumns({c: _r6(c) for c in ("avg_elapsed_ms", "rate_recomputed")})


@query
def status_distribution(spark, sf):
    rows, stats = _overlaid(spark, sf)
    out = R.status_distribution(rows, R.success(R.stat_overlay(rows, stats)))
    return out.withColumn("rank", F.col("rank").cast("bigint")).withColumn(
        "share_pct", _r6("share_pct")
    )


@query
def top_domains(spark, sf):
    out = R.top_domains(D.crawl_log(spark, sf))
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query
def phase_p50(spark, sf):
    return R.phase_percentiles(D.crawl_log(spark, sf)).select("log", "phase", "p50")


@query
def phase_p95(spark, sf):
    return R.phase_percentiles(D.crawl_log(spark, sf)).select("log", "phase", "p95")


@query
def discovery(spark, sf):
    out = R.discovery(D.crawl_log(spark, sf))
    return out.withColumn("truncated_pct", _r6("truncated_pct"))


@query
def analyze_log(spark, sf):
    out = R.quick_statistics(L.log_rows_lenient(D.raw_log(spark, sf)))
    out = out.withColumn("rank", F.col("rank").cast("bigint"))
    return out.withColumns({c: _r6(c) for c in ("avg_elapsed_ms", "rate_recomputed")})


def _summary(spark, sf):
    return R.run_summary(*_overlaid(spark, sf))


@query
def run_summary(spark, sf):
    return _summary(spark, sf)


@query
def report_summary(spark, sf):
    """Summary table of the report, straight from raw log lines."""
    return PR.report_of_lines(D.raw_log(spark, sf)).summary


@query
def report_timing(spark, sf):
    """Timing table of the report, straight from raw log lines."""
    return PR.report_of_lines(D.raw_log(spark, sf)).timing


@query
def report_discovery(spark, sf):
    """Discovery table of the report, straight from raw log lines."""
    out = PR.report_of_lines(D.raw_log(spark, sf)).discovery
    return out.withColumn("truncated_pct", _r6("truncated_pct"))


@query
def report_statuses(spark, sf):
    """Status table of the report, straight from raw log lines."""
    out = PR.report_of_lines(D.raw_log(spark, sf)).statuses
    return out.withColumn("rank", F.col("rank").cast("bigint")).withColumn("share_pct", _r6("share_pct"))


@query
def report_domains(spark, sf):
    """Domain table of the report, straight from raw log lines."""
    out = PR.report_of_lines(D.raw_log(spark, sf)).domains
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query
def domain_counts(spark, sf):
    return R.domain_counts(D.crawl_log(spark, sf))


@query
def status_class(spark, sf):
    return R.status_classes(D.crawl_log(spark, sf))


@query
def fmt_bytes(spark, sf):
    scale = F.element_at(
        F.array(*[F.lit(1000**i).cast("bigint") for i in range(4)]), (F.col("seq") % 4 + 1).cast("int")
    )
    size = F.col("bytes") * scale
    return D.crawl_log(spark, sf).select("seq", M.human_bytes(size).alias("size"))


@query
def running_domain_counts(spark, sf):
    out = O.running_domain_counts(D.stored_log(spark, sf), "seq", BLOCK)
    return out.select("log", "seq", "domain", "domain_count", "superdomain", "super_count")


@query
def running_backoff(spark, sf):
    rows = D.stored_log(spark, sf)
    out = O.running_backoff(rows, M.is_backoff_status(F.col("status")), block=BLOCK)
    return out.select("log", "seq", "domain", "earlier_failures", "blocked")


# -- streaming -------------------------------------------------------------------------------


@query
def stream_totals(spark, sf):
    return live.live_totals(D.log_stream(spark, sf))


@query
def stream_dedupe(spark, sf):
    return live.live_visited(D.log_stream(spark, sf))


@query
def stream_dedupe_bounded(spark, sf):
    return live.live_sightings(D.visit_stream(spark, sf), "ts", "1 day", "1 day")


@query
def stream_domain_state(spark, sf):
    return live.live_domains(D.log_stream(spark, sf), 30)


@query
def stream_links(spark, sf):
    return live.live_links(live.read_stream(spark, sf, "pages.parquet"))
