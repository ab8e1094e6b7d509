"""Traversal and whole crawls against single-process simulations."""

import math
import random
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from linkloom.plans import traverse as T
from linkloom.workload import derive as D

BACKOFF = (429, 417, 403, 401, 500, 0)


def graph(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string")


def depths(edges, seeds, limit):
    out, level, d = {}, set(seeds), 0
    while level:
        out.update({u: d for u in level})
        if d == limit:
            break
        level = {b for a, b in edges if a in level} - set(out)
        d += 1
    return out


@pytest.mark.parametrize("hot_edges", [20, 10**6])
def test_bfs_with_a_hub(spark, hot_edges):
    """A third of the edges leave one page, another third enter one."""
    rng = random.Random(2)
    edges = [("hub", f"n{i}") for i in range(60)] + [(f"n{i}", "sink") for i in range(60)]
    edges += [(f"n{rng.randint(0, 59)}", f"m{rng.randint(0, 40)}") for _ in range(60)]
    edges += [("sink", "hub"), ("m1", "m1"), ("m2", "end")]
    df = graph(spark, edges)
    seeds = spark.createDataFrame([("hub",), ("hub",)], "url string")
    for limit in (0, 1, 10):
        got = {r.url: r.depth for r in T.bfs_depths(df, seeds, limit, hot_edges).collect()}
        assert got == depths(edges, ["hub"], limit)
    if hot_edges == 20:
        table = T.LinkTable.of(df, hot_edges)
        assert {r.src for r in table.hot.collect()} == {"hub"}
        assert table.edges.filter("src = 'hub'").select("_salt").distinct().count() > 1
        assert table.edges.count() == len(edges)


def test_bfs_with_bucketed_levels(spark, monkeypatch):
    """The large-level path: every level bucketed and joined by itself."""
    import linkloom.session as S

    monkeypatch.setattr(S, "STORE_ROWS", 0)
    monkeypatch.setattr(T, "STORE_ROWS", 0)
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d"), ("d", "e")]
    seeds = spark.createDataFrame([("a",)], "url string")
    got = {r.url: r.depth for r in T.bfs_depths(graph(spark, edges), seeds).collect()}
    assert got == depths(edges, ["a"], 10)


def test_stored_table_joins_without_shuffling_it(spark):
    from linkloom.session import store

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = store(spark.range(1000).withColumn("k", F.col("id") % 50), "k")
        plan = spark.range(50).withColumnRenamed("id", "k").join(big, "k")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1
        assert plan.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_crawl_order_is_breadth_first(spark, small):
    out = T.crawl_order(D.graph_edges(spark, small), D.graph_seed(spark, small)).orderBy("rank").collect()
    assert [r["rank"] for r in out] == list(range(1, len(out) + 1))
    assert [r.depth for r in out] == sorted(r.depth for r in out)
    cut_short = T.crawl_order(D.graph_edges(spark, small), D.graph_seed(spark, small), max_pages=7)
    assert {r.url for r in cut_short.collect()} == {r.url for r in out[:7]}


def simulate(pages, seeds, robots, agent, max_pages, max_depth, skip=(), threshold=5, unreachable=False):
    """One process, one level at a time; counters are those of the levels before."""

    def host(url):
        return urlsplit(url).hostname

    def permitted(url):
        status, body = robots.get(host(url), (0, None))
        if status == 200:
            parser = RobotFileParser()
            parser.parse(body.splitlines())
            return parser.can_fetch(agent, url)
        if status in (401, 403):
            return False
        return 400 <= status < 500 or unreachable

    def static(url):
        return not urlsplit(url).path.lower().endswith((".pdf", ".jpg")) and host(url) not in skip

    log, blocked, depth_of = [], [], {}
    wave = [(i, 0, u) for i, u in enumerate(seeds) if static(u)]
    failures, seen_d, seen_s = {}, {}, {}
    down_from = {}
    for depth in range(max_depth + 1):
        first = {}
        for parent, pos, url in wave:
            if url not in depth_of and failures.get(host(url), 0) < threshold:
                first[url] = min(first.get(url, (parent, pos)), (parent, pos))
        keyed = []
        for url, (parent, pos) in first.items():
            d, s = host(url), ".".join(host(url).split(".")[-2:])
            bonus = 1.0 / math.log2(2 + seen_d.get(d, 0)) + 0.3 / math.log2(2 + seen_s.get(s, 0))
            keyed.append((depth - 0.001 * bonus, parent, pos, url))
        visited = []
        for priority, _, _, url in sorted(keyed):
            if len(log) >= max_pages:
                break
            depth_of[url] = depth
            if not permitted(url):
                blocked.append(url)
                continue
            status, ct, links = pages.get(url, (0, "", []))
            log.append([url, depth, priority, status, ct, links])
            visited.append((len(log), url, status, ct, links))
        for _, url, status, _, _ in visited:
            d, s = host(url), ".".join(host(url).split(".")[-2:])
            seen_d[d] = seen_d.get(d, 0) + 1
            seen_s[s] = seen_s.get(s, 0) + 1
            failures[d] = failures.get(d, 0) + (status in BACKOFF)
            if failures[d] >= threshold:
                down_from.setdefault(d, depth)
        wave = [
            (place, pos, link)
            for place, url, status, ct, links in visited
            if status == 200 and ct.startswith("text/html") and depth < max_depth
            for pos, link in enumerate(links)
            if static(link)
        ]
        if len(log) >= max_pages or not wave:
            break
    rows, n_d, n_s = [], {}, {}
    for seq, (url, depth, priority, status, ct, links) in enumerate(log, 1):
        d, s = host(url), ".".join(host(url).split(".")[-2:])
        n_d[d] = n_d.get(d, 0) + 1
        n_s[s] = n_s.get(s, 0) + 1
        parsed = status == 200 and ct.startswith("text/html") and depth < max_depth
        found = len(links) if parsed else 0
        enqueued = sum(
            static(x) and depth_of.get(x, 99) > depth and down_from.get(host(x), 99) > depth for x in links
        )
        rows.append((seq, url, depth, round(priority, 9), status, n_d[d], n_s[s], found, enqueued if parsed else 0))
    return rows, sorted(blocked)


def site(seed, n=120):
    rng = random.Random(seed)
    urls = [f"https://h{i % 9}.s{i % 4}.com/p/{i}" for i in range(n)]
    urls += [f"https://h{i % 9}.s{i % 4}.com/f/{i}.pdf" for i in range(5)]
    pages = {}
    for i, url in enumerate(urls):
        if rng.random() < 0.9:
            links = list(dict.fromkeys(rng.choice(urls) for _ in range(rng.randint(0, 8))))
            links += [f"https://gone{rng.randint(0, 2)}.com/{rng.randint(0, 9)}"] * (rng.random() < 0.3)
            status = rng.choice([200] * 9 + [404, 403, 500])
            pages[url] = status, rng.choice(["text/html; charset=utf-8"] * 6 + ["application/json"]), links
    hosts = sorted({urlsplit(u).hostname for u in urls} | {f"gone{i}.com" for i in range(3)})
    bodies = ["User-agent: *\nDisallow: /p/7", "", "User-agent: testbot\nDisallow: /p/11\n\nUser-agent: *\nDisallow: /"]
    robots = {h: (200, bodies[i % 3]) if i % 11 else (404, None) for i, h in enumerate(hosts)}
    robots[hosts[3]] = (503, None)
    return pages, robots, urls


@pytest.mark.parametrize(
    "seed, options",
    [(1, {}), (2, {"max_pages": 25}), (3, {"max_depth": 3}), (4, {"skip": True}), (5, {"threshold": 2, "unreachable": True})],
)
def test_crawl_equals_the_simulation(spark, seed, options):
    pages, robots, urls = site(seed)
    seeds = [*urls[:8], urls[0], urls[-1]]
    max_pages, max_depth = options.get("max_pages", 5000), options.get("max_depth", 10)
    skip = {"h2.s2.com", "h4.s0.com"} if options.get("skip") else set()
    threshold, unreachable = options.get("threshold", 5), options.get("unreachable", False)
    rows, blocked = simulate(pages, seeds, robots, "testbot-1/1.0", max_pages, max_depth, skip, threshold, unreachable)

    table = [
        (i, u, "<p>x</p>" + " ".join(f'<a href="{x}">' for x in links), status, ct)
        for i, (u, (status, ct, links)) in enumerate(pages.items())
    ]
    # A later copy of every page that leads nowhere: the first copy must win.
    table += [(10_000 + r[0], r[1], "<a href='/copy'>", 200, "text/html") for r in table[:40]]
    result = T.crawl(
        spark.createDataFrame(table, "page_id int, url string, html string, status int, ct string").repartition(5),
        spark.createDataFrame(list(enumerate(seeds)), "ord int, url string"),
        spark.createDataFrame([(h, s, b) for h, (s, b) in robots.items()], "host string, status int, body string"),
        "testbot-1/1.0",
        max_pages=max_pages,
        max_depth=max_depth,
        skip=spark.createDataFrame([(h,) for h in skip], "domain string") if skip else None,
        backoff=threshold,
        on_unreachable="allow" if unreachable else "deny",
        block=16,
    )
    got = [
        (r.seq, r.url, r.depth, round(r.priority, 9), r.status, r.domain_count, r.super_count, r.links_found,
         r.links_enqueued)
        for r in result.log.orderBy("seq").collect()
    ]
    assert got == rows
    assert sorted(r.url for r in result.blocked.collect()) == blocked
    assert len(rows) > 10


def enqueued(edges, seeds, limit):
    """Queue order of one process."""
    out = {}
    for u in seeds:
        out.setdefault(u, 0)
    level = list(out)
    for d in range(1, limit + 1):
        following = []
        for page in level:
            for _, b in sorted((pos, b) for a, pos, b in edges if a == page):
                if b not in out:
                    out[b] = d
                    following.append(b)
        level = following
    return {u: (d, k + 1) for k, (u, d) in enumerate(out.items())}


@pytest.mark.parametrize("limit, hot_edges", [(10, 20), (2, 10**6), (0, 10**6)])
def test_enqueue_order_is_the_queues(spark, limit, hot_edges):
    rng = random.Random(limit)
    edges = [("n0", i, f"n{i % 40}") for i in range(60)]
    edges += [(f"n{rng.randint(0, 79)}", 100 + i, f"n{rng.randint(0, 79)}") for i in range(150)]
    seeds = ["n9", "n0", "n9", "n70"]
    df = spark.createDataFrame(edges, "src string, pos int, dst string").repartition(3)
    start = spark.createDataFrame([(u, i) for i, u in enumerate(seeds)], "url string, ord int")
    got = {r.url: (r.depth, r.seq) for r in T.enqueue_order(df, start, limit, hot_edges).collect()}
    assert got == enqueued(edges, seeds, limit)


def test_crawl_order_breaks_ties_by_the_queue(spark):
    """All URLs of a level are on one host, so their priorities are equal."""
    edges = [("https://h.com/z", 0, "https://h.com/m"), ("https://h.com/z", 1, "https://h.com/a"), ("https://h.com/m", 0, "https://h.com/k")]
    seeds = spark.createDataFrame([("https://h.com/z", 0)], "url string, ord int")
    df = spark.createDataFrame(edges, "src string, pos int, dst string")
    out = T.crawl_order(df, seeds).orderBy("rank").collect()
    assert [(r.url[-1], r.seq) for r in out] == [("z", 1), ("m", 2), ("a", 3), ("k", 4)]


def test_counters_fold_levels(spark):
    schema = "domain string, superdomain string, status int, refused boolean"
    levels = [
        [("a.x", "x", 200, False), ("a.x", "x", 500, False), ("b.x", "x", 200, True)],
        [("a.x", "x", 0, False), ("b.x", "x", 200, False), ("c.y", "y", 429, False)],
        [],
    ]
    counters = T.Counters()
    for rows in levels:
        counters = counters.fold(spark.createDataFrame(rows, schema))
    assert {tuple(r) for r in counters.by_domain.collect()} == {("a.x", "x", 3, 2), ("b.x", "x", 1, 0), ("c.y", "y", 1, 1)}
    out = spark.createDataFrame([(d, d[2:]) for d in ("a.x", "b.x", "c.y", "d.y", "e.z")], "domain string, superdomain string")
    got = {r.domain: (r.domain_seen, r.super_seen) for r in counters.attached(out, 2).collect()}
    assert got == {"b.x": (1, 4), "c.y": (1, 1), "d.y": (0, 1), "e.z": (0, 0)}


def test_final_url_is_carried_and_changes_nothing(spark):
    from linkloom.sources import pages as P

    rows = [
        (1, "https://a.com/x/", '<a href="y">y</a><a href="/z">z</a>', "https://b.com/elsewhere/"),
        (2, "https://a.com/x/y", "", None),
        (3, "https://a.com/z", "", "https://a.com/z"),
        (4, "https://A.com/x/", "", "https://c.com/later"),
    ]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, final_url string")
    seeds = spark.createDataFrame([("https://a.com/x/", 0)], "url string, ord int")
    log = T.crawl(df, seeds, None, "bot").log.orderBy("seq")
    assert [(r.url, r.final_url) for r in log.collect()] == [
        ("https://a.com/x/", "https://b.com/elsewhere/"),
        ("https://a.com/x/y", "https://a.com/x/y"),
        ("https://a.com/z", "https://a.com/z"),
    ]
    plain = T.crawl(df.drop("final_url"), seeds, None, "bot").log.orderBy("seq")
    assert plain.collect() == log.drop("final_url").collect()
    assert {tuple(r) for r in P.redirects(df).collect()} == {("https://a.com/x/", "https://b.com/elsewhere/")}
    assert "final_url" in P.snapshot(df).columns and "final_url" not in P.snapshot(df.drop("final_url")).columns


def test_crawl_log_goes_through_writer_and_report(spark, small):
    from linkloom.operators import report as R
    from linkloom.session import fresh_path
    from linkloom.sources import crawl_log as L

    crawled = T.crawl(D.graph_snapshot(spark, small), D.graph_seed(spark, small), None, D.USER_AGENT, max_depth=2)
    path = fresh_path(spark, "crawl")
    L.write_log(crawled.log, path)
    back, _ = L.log_lines(spark, path)
    rows = L.log_rows_with_debug(back)
    assert rows.count() == crawled.log.count() > 0
    assert R.discovery(rows).first().links_found == crawled.log.agg(F.sum("links_found")).first()[0]
