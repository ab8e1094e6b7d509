"""Inputs of the registered queries, derived by Spark from the given tables.

Each function mirrors one common table expression of ``oracle.py``. All rules are integer
arithmetic on whole tables, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import urls as U
from linkloom.operators.links import distinct_in_order, with_links
from linkloom.operators.ordering import running_domain_counts
from linkloom.session import cut, fresh_path
from linkloom.sources import crawl_log as L
from linkloom.sources.pages import enough_tasks
from linkloom.streaming.live import read_stream

USER_AGENT = "testbot-1/1.0 (x)"

# Rows that one task writes to its files of the logs, about: it sorts them by log.
FILE_ROWS = 250_000


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/pages.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def parse_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages spread over all cores, for the passes that parse bodies."""
    return enough_tasks(pages(spark, sf))


def n_pages(spark: SparkSession, sf: str) -> Column:
    return pages(spark, sf).agg(F.count("*")).scalar()


def url_facts(pages_df: DataFrame) -> DataFrame:
    """What a page's URL tells; bodies are not read."""
    url = U.canonical_url(F.col("url"))
    return pages_df.select(
        "page_id",
        url.alias("url"),
        U.url_domain(url).alias("domain"),
        U.superdomain(U.url_domain(url)).alias("superdomain"),
    )


def page_facts(pages_df: DataFrame) -> DataFrame:
    """Narrow page attributes; bodies stay behind."""
    parsed = with_links(pages_df.select("page_id", "url", "html"), "robust", hrefs=True)
    distinct = distinct_in_order(F.transform("hrefs", lambda h: h["href"]))
    url = U.canonical_url(F.col("url"))
    return parsed.select(
        "page_id",
        url.alias("url"),
        U.url_domain(url).alias("domain"),
        U.superdomain(U.url_domain(url)).alias("superdomain"),
        F.octet_length("html").cast("bigint").alias("size"),
        F.size(distinct).cast("bigint").alias("n_links"),
    )


def visits_from(events_df: DataFrame, facts: DataFrame, n: Column) -> DataFrame:
    """One visit per event, the page chosen by event_id: what of a log row needs no body."""
    e = F.col("event_id")
    status = (
        F.when((F.col("event_type") == "signup") & (e % 4 == 0), 404)
        .when(
            F.col("event_type") == "error",
            F.element_at(F.array(*map(F.lit, (429, 417, 403, 401, 500, 0))), (e % 6 + 1).cast("int")),
        )
        .otherwise(200)
    )
    return events_df.select(
        F.concat(F.lit("run"), F.col("user_id") % 3).alias("log"),
        e.alias("seq"),
        (e % n).alias("page_id"),
        "event_id",
        "ts",
        status.cast("int").alias("status"),
        (F.col("user_id") % 5).cast("int").alias("depth"),
        ((F.col("user_id") % 5) - (e % 7) * F.lit(0.000125)).alias("priority"),
        (100 + F.floor(F.col("value") * 10)).cast("bigint").alias("elapsed_ms"),
        (e % 10 != 0).alias("debug_ok"),
    ).join(facts, "page_id")


def log_from(events_df: DataFrame, facts: DataFrame, n: Column) -> DataFrame:
    """Crawl-log rows: one per visit."""
    e = F.col("event_id")
    good = F.col("status") == 200
    size = F.when(good, F.col("size")).otherwise(0).cast("bigint")
    rows = visits_from(events_df, facts, n).withColumn("bytes", size)
    found = F.when(good, F.col("n_links")).otherwise(0)

    def tail(x: Column) -> Column:
        return F.when(F.col("debug_ok"), x)

    return rows.select(
        "log", "seq", "ts", "url", "status", "bytes", "depth", "priority", "domain", "superdomain",
        "elapsed_ms",
        tail(F.lit("text/html")).alias("ct"),
        tail(F.expr("elapsed_ms * 7 div 10")).alias("t_connect_ms"),
        tail(F.expr("elapsed_ms * 2 div 10")).alias("t_read_ms"),
        tail(e % 50).alias("t_parse_ms"),
        tail(found).cast("bigint").alias("links_found"),
        tail(F.greatest(F.lit(0), found - e % 3)).cast("bigint").alias("links_enqueued"),
        tail(F.when(F.col("bytes") >= 4096, 1).otherwise(0)).cast("int").alias("html_truncated"),
        "debug_ok",
    )


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Page attributes, kept: a join would otherwise work them out again for every event."""
    return cut(page_facts(parse_pages(spark, sf)))


def urls_of_pages(spark: SparkSession, sf: str) -> DataFrame:
    """URL attributes of the pages, kept as ``facts`` are."""
    return cut(url_facts(pages(spark, sf)))


def visits(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows without what comes from bodies, for queries that ask for URLs, domains and statuses."""
    return visits_from(events(spark, sf), urls_of_pages(spark, sf), n_pages(spark, sf))


def crawl_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log for queries that read it once."""
    return log_from(events(spark, sf), facts(spark, sf), n_pages(spark, sf))


def stored_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log for queries that read it several times."""
    return cut(crawl_log(spark, sf))


def raw_log(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines with damaged rows, headers, empty lines and STAT lines: ``log, ord, line``."""
    rows = stored_log(spark, sf)
    s = F.col("seq")
    rule = (
        F.when(s % 97 == 0, 97).when(s % 101 == 0, 101).when(s % 103 == 0, 103)
        .when(s % 107 == 0, 107).when(s % 109 == 0, 109).when(s % 113 == 0, 113).otherwise(0)
    )
    text = F.col
    head = [
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        text("url"),
        F.when(rule == 103, "abc").otherwise(F.col("status").cast("string")),
    ]
    size = F.when(rule == 97, "n/a").when(rule == 107, "-5").otherwise(F.col("bytes").cast("string"))
    mid = [
        size,
        F.col("depth").cast("string"),
        F.format_string("%.6f", F.col("priority")),
        text("domain"),
        s.cast("string"),
        text("superdomain"),
    ]
    end = [s.cast("string"), F.col("elapsed_ms").cast("string")]
    flag = F.when(rule == 109, "x").otherwise(F.col("html_truncated").cast("string"))
    debug = [
        F.col(c).cast("string")
        for c in ("ct", "t_connect_ms", "t_read_ms", "t_parse_ms", "links_found", "links_enqueued")
    ]
    short = F.concat_ws("\t", *head, *mid)
    full = F.concat_ws("\t", *head, *mid, *end)
    wide = F.concat_ws("\t", full, *debug, flag)
    line = (
        F.when(rule == 101, short)
        .when(F.col("debug_ok") & (rule == 113), F.concat(wide, F.lit("\t7")))
        .when(F.col("debug_ok"), wide)
        .otherwise(full)
    )
    body = rows.select("log", s.alias("ord"), line.alias("line"))
    extra = F.explode(
        F.array(
            F.struct(F.lit(-1).alias("k"), F.lit("timestamp\turl\tstatus").alias("line")),
            F.struct(F.lit(1).alias("k"), F.lit("").alias("line")),
            F.struct(F.lit(2).alias("k"), F.lit("STAT\tpages_crawled\t1").alias("line")),
            F.struct(
                F.lit(3).alias("k"),
                F.concat(F.lit("STAT\tpages_crawled\t"), F.col("n").cast("string")).alias("line"),
            ),
            F.struct(F.lit(4).alias("k"), F.lit("STAT\ttotal_bytes\tn/a").alias("line")),
            F.struct(F.lit(5).alias("k"), F.lit("STAT\telapsed_sec\t12.5").alias("line")),
            F.struct(F.lit(6).alias("k"), F.lit("STAT\tnum_404\t7.9").alias("line")),
        )
    ).alias("x")
    ends = rows.groupBy("log").agg(F.count("*").alias("n"), F.max("seq").alias("last"))
    marks = ends.select("log", "last", extra).select(
        "log",
        F.when(F.col("x.k") < 0, -1).otherwise(F.col("last") + F.col("x.k")).cast("bigint").alias("ord"),
        F.col("x.line").alias("line"),
    )
    return cut(body.unionByName(marks))


def url_variants(spark: SparkSession, sf: str, with_suffix: bool = False) -> DataFrame:
    """Page URLs, their queries and fragments behind, rewritten so that normalisation has work to do:
    ``page_id, raw``."""
    p = F.col("page_id")
    plain = F.regexp_extract("url", r"^([^?#]*)", 1)
    if with_suffix:
        plain = F.concat(plain, F.when(p % 3 == 0, ".pdf").when(p % 3 == 1, ".html").otherwise(""))
    origin = F.regexp_extract(plain, r"^([^:]*://[^/]*)", 1)
    rest = F.regexp_extract(plain, r"^[^:]*://[^/]*(.*)$", 1)
    tail = F.regexp_extract("url", r"^[^?#]*(.*)$", 1)
    k = p % 8
    raw = (
        F.when(k == 1, F.concat(F.upper(origin), rest))
        .when(k == 2, F.concat(origin, F.lit(":80"), rest))
        .when(k == 3, F.concat(origin, F.lit(":443"), rest))
        .when(k == 4, F.concat(origin, F.lit(":8080"), rest))
        .when(k == 5, F.concat(plain, F.lit("#frag")))
        .when(k == 6, F.concat(plain, F.lit(";v=1?a=1")))
        .when(k == 7, F.concat(plain, F.lit(".JPG")))
        .otherwise(plain)
    )
    return cut(pages(spark, sf).select("page_id", F.concat(raw, tail).alias("raw")))


def href_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Nine hrefs per page, navigable and not: ``page_id, pos, href``."""
    host = U.authority_of(F.col("url"))
    word = F.concat(F.lit("/p"), F.col("page_id").cast("string"))
    hrefs = [
        word,
        F.concat(F.lit("HTTP://"), host, word),
        F.concat(F.lit("https://"), host, word),
        F.concat(F.lit("mailto:a@"), host),
        F.concat(F.lit("  JavaScript:go("), F.col("page_id").cast("string"), F.lit(")")),
        F.concat(F.lit("tel:"), F.col("page_id").cast("string")),
        F.concat(F.lit("DATA:,"), F.col("page_id").cast("string")),
        F.concat(F.lit("ftp://"), host, word),
        F.lit(""),
    ]
    return pages(spark, sf).select(
        "page_id", F.posexplode(F.array(*hrefs)).alias("pos", "href")
    ).withColumn("pos", F.col("pos").cast("bigint"))


def seed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Seven lines of a seed file per page: ``ord, line``."""
    url = F.col("url")
    lines = [
        F.concat(F.lit("# page "), F.col("page_id").cast("string")),
        F.lit(""),
        F.concat(F.lit("  "), url, F.lit("  ")),
        F.concat(url, F.lit("x  # note")),
        F.concat(url, F.lit("x")),
        F.lit("   "),
        U.authority_of(F.col("url")),
    ]
    return pages(spark, sf).select(
        "page_id", F.posexplode(F.array(*lines)).alias("k", "line")
    ).select((F.col("page_id") * 7 + F.col("k")).alias("ord"), "line")


def graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of a link graph over the page ids: ``page_id, url``."""
    return pages(spark, sf).select("page_id", node_url(F.col("page_id")).alias("url"))


def node_url(page_id: Column) -> Column:
    return F.concat(
        F.lit("https://h"), (page_id % 17).cast("string"),
        F.lit(".example.com/p/"), page_id.cast("string"),
    )


def graph_targets(n: Column) -> Column:
    """Page ids the node links to, in page order."""
    a = F.col("page_id")
    nxt = F.when((a % 4 != 3) & (a + 1 < n), a + 1)
    square = F.when(a % 5 == 0, (a * a + 1) % n)
    return F.array_compact(F.array(nxt, (3 * a + 7) % n, square))


def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges ``src, pos, dst`` with cycles, repeats and several paths to a node."""
    return (
        pages(spark, sf)
        .select("page_id", F.posexplode(graph_targets(n_pages(spark, sf))).alias("pos", "to"))
        .select(
            node_url(F.col("page_id")).alias("src"),
            F.col("pos").cast("bigint").alias("pos"),
            node_url(F.col("to")).alias("dst"),
        )
    )


def graph_seed(spark: SparkSession, sf: str) -> DataFrame:
    """The node of the smallest page id."""
    return pages(spark, sf).agg(F.min("page_id").alias("page_id")).select(
        node_url(F.col("page_id")).alias("url"), F.lit(0).cast("bigint").alias("ord")
    )


def graph_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose bodies hold the graph's links after their own text, with fetch attributes."""
    a = F.col("page_id")
    anchors = F.array_join(
        F.transform(
            graph_targets(F.col("n")),
            lambda t: F.concat(F.lit('<a href="'), node_url(t), F.lit('">x</a>')),
        ),
        " ",
    )
    status = F.when(a % 11 == 5, 503).when(a % 13 == 7, 403).when(a % 19 == 4, 404).otherwise(200)
    return parse_pages(spark, sf).withColumn("n", n_pages(spark, sf)).select(
        "page_id",
        node_url(a).alias("url"),
        F.concat(F.lit("<html><body>"), anchors, F.lit("<hr>"), F.col("html")).alias("html"),
        status.cast("int").alias("status"),
        F.when(a % 23 == 9, "application/json").otherwise("text/html; charset=utf-8").alias("ct"),
    )


def robots(spark: SparkSession, sf: str) -> DataFrame:
    """One robots answer per host of the pages, eight kinds in turn: ``host, status, body``."""
    hosts = (
        pages(spark, sf)
        .select("page_id", U.url_domain(F.col("url")).alias("host"))
        .groupBy("host")
        .agg(F.min("page_id").alias("p"))
    )
    return robots_for(hosts)


def robots_for(hosts: DataFrame) -> DataFrame:
    k = F.col("p") % 8
    body = (
        F.when(k == 0, "User-agent: *\nDisallow: /de")
        .when(k == 1, "User-agent: *\nAllow: /en/1\nDisallow: /en")
        .when(k == 2, "User-agent: *\nDisallow: /en\nAllow: /en/1")
        .when(k == 3, "User-agent: *\nDisallow: /\n\nUser-agent: testbot\nDisallow: /es")
        .when(k == 4, "")
    )
    status = F.when(k == 5, 503).when(k == 6, 403).when(k == 7, 404).otherwise(200)
    return hosts.select("host", status.cast("int").alias("status"), body.alias("body"))


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate URLs, half of them without a page: ``event_id, url, ct, depth, domain, superdomain``."""
    e = F.col("event_id")
    known = urls_of_pages(spark, sf).select("page_id", F.col("url").alias("known"))
    url = F.coalesce(
        "known", F.concat(F.lit("https://missing.example.com/"), F.col("page_id").cast("string"))
    )
    picked = events(spark, sf).select(
        "event_id", (e % (2 * n_pages(spark, sf))).alias("page_id")
    )
    ct = (
        F.when(e % 4 < 2, "text/html; charset=utf-8").when(e % 4 == 2, "application/json")
        .otherwise("")
    )
    return (
        picked.join(known, "page_id", "left")
        .select(
            "event_id",
            url.alias("url"),
            ct.alias("ct"),
            (e % 12).cast("int").alias("depth"),
        )
        .withColumn("domain", U.url_domain(F.col("url")))
        .withColumn("superdomain", U.superdomain(F.col("domain")))
    )


def skip_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts with fewer pages than the mean host, as a skip list."""
    hosts = pages(spark, sf).select(U.url_domain(F.col("url")).alias("domain"))
    sizes = hosts.groupBy("domain").agg(F.count("*").alias("n"))
    return sizes.filter(F.col("n") < sizes.agg(F.avg("n")).scalar()).select("domain")


def queue_items(spark: SparkSession, sf: str) -> DataFrame:
    """Frontier rows, the same URL several times over: ``url, priority, depth, seq``."""
    a = F.col("page_id")
    depth = (a % 5).cast("int")
    return (
        pages(spark, sf)
        .select("page_id", F.posexplode(graph_targets(n_pages(spark, sf))).alias("pos", "to"))
        .select(
            node_url(F.col("to")).alias("url"),
            (depth - (a % 7) * F.lit(0.001)).alias("priority"),
            depth.alias("depth"),
            (a * 4 + F.col("pos")).cast("bigint").alias("seq"),
        )
    )


def graph_robots(spark: SparkSession, sf: str) -> DataFrame:
    """Robots answers of the graph's hosts, rules that meet its paths: ``host, status, body``."""
    hosts = (
        pages(spark, sf)
        .select("page_id", U.url_domain(node_url(F.col("page_id"))).alias("host"))
        .groupBy("host")
        .agg(F.min("page_id").alias("p"))
    )
    p = F.col("p")
    body = (
        F.when(p == 1, "User-agent: testbot\nDisallow: /p/7\n\nUser-agent: *\nDisallow: /")
        .when(p == 2, "User-agent: *\nAllow: /p/2\nDisallow: /p/1")
        .otherwise("User-agent: *\nDisallow: /p/9")
    )
    status = F.when(p == 5, 503).when(p == 6, 403).when(p == 8, 404).otherwise(200)
    return hosts.select("host", status.cast("int").alias("status"), body.alias("body"))


def counted_log(spark: SparkSession, sf: str, block: int) -> DataFrame:
    """Crawl-log rows with their running domain and superdomain counts."""
    return running_domain_counts(stored_log(spark, sf), "seq", block)


def log_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The crawl log as a stream of events against the static page facts."""
    n = F.lit(pages(spark, sf).count())
    return log_from(read_stream(spark, sf, "events.parquet"), facts(spark, sf), n)


def damaged_logs(spark: SparkSession, sf: str, block: int) -> list[str]:
    """Three whole logs, gzipped; a fourth that has one file of the first cut in half beside a whole one, a
    fifth whose file is no gzip, a sixth without files, and a seventh that is not there. A log has as many
    files as its rows ask for, two at least."""
    path = fresh_path(spark, "logs")
    log = stored_log(spark, sf)
    files = max(2, -(-log.count() // FILE_ROWS))
    rows = running_domain_counts(log, "seq", block)
    L.write_log(rows.repartition(files, "seq"), path, compression="gzip")
    L.write_log(rows.filter("log = 'run0'").drop("log"), f"{path}/plain")
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path
    fs = place(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def parts(folder: str) -> list:
        found = fs.listStatus(place(f"{path}/{folder}"))
        return [f for f in found if f.getPath().getName().startswith("part-")]

    def copy(file, to: str, size: int) -> None:
        source, target = fs.open(file.getPath()), fs.create(place(f"{path}/{to}"))
        jvm.org.apache.commons.io.IOUtils.copyLarge(source, target, 0, size)
        target.close()
        source.close()

    for k, file in enumerate(parts("log=run0")):
        copy(file, f"log=cut/part-{k}.csv.gz", file.getLen() if k else file.getLen() // 2)
    for k, file in enumerate(parts("plain")):
        copy(file, f"log=plain/part-{k}.csv.gz", file.getLen())
    fs.mkdirs(place(f"{path}/log=empty"))
    names = ("run0", "cut", "run1", "plain", "run2", "empty", "none")
    return [f"{path}/log={name}" for name in names]


def damaged_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with anchors written in eight ways that parsers read alike or are known to differ on:
    ``page_id, url, html``. Five in eight are not plain, and one in eight breaks the parser off."""
    p = F.col("page_id").cast("string")
    k = F.col("page_id") % 8

    def text(*parts) -> Column:
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    before = (
        F.when(k == 0, text("<a href=/u", p, ">u</a>"))
        .when(k == 1, text('<a href = "/s', p, '">s</a>'))
        .when(k == 2, text('<a href="/e', p, '?a=1&#38;b=2">e</a>'))
        .when(k == 3, text('<a href="/one', p, '" href="/two', p, '">t</a>'))
        .when(k == 4, text("<A @click=\"go()\" HREF='/q", p, "'>q</A><!-- <a href=\"/no", p, '">n</a> -->'))
        .when(k == 5, text('<a title="a>b" href = /g', p, '><a href="/h', p, '">h</a></a>'))
        .when(k == 6, text('<a href="/b', p, '">b</a><![odd[ <a href="/lost', p, '">l</a>'))
        .otherwise("")
    )
    after = F.when(k == 7, text('<a href="/y', p, '">y</a><a class="x" href = "/cut', p)).otherwise("")
    html = F.concat(F.lit("<html><body>"), before, F.lit("<hr>"), F.col("html"), after)
    return parse_pages(spark, sf).select("page_id", "url", html.alias("html"))


def robots_copies(spark: SparkSession, sf: str) -> DataFrame:
    """A robots answer per page, so several per host, of one to five kinds: ``host, status, body``."""
    hosts = pages(spark, sf).select("page_id", U.url_domain(F.col("url")).alias("host"))
    least = hosts.groupBy("host").agg(F.min("page_id").alias("p"))
    kinds = F.col("p") % 5
    kind = F.col("page_id") % (kinds + 1) + 4 - kinds
    status = (
        F.when(kind == 0, 200).when(kind == 1, 404).when(kind == 2, 403).when(kind == 3, 503)
        .when(F.col("page_id") % 2 == 0, 0)
    )
    body = F.when(kind == 0, "User-agent: *\nDisallow: /en")
    return hosts.join(least, "host").select("host", status.cast("int").alias("status"), body.alias("body"))


def visit_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Visits as a stream of events against the static URL attributes."""
    n = F.lit(pages(spark, sf).count())
    return visits_from(read_stream(spark, sf, "events.parquet"), urls_of_pages(spark, sf), n)


def redirected_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a ``final_url``: a third lead to a page of their host, a third to themselves, a third tell
    nothing."""
    p, url = F.col("page_id"), U.canonical_url(F.col("url"))
    other = F.concat(F.regexp_extract(url, "^([^:]*://[^/]*)", 1), F.lit("/to/"), p.cast("string"), F.lit("#x"))
    final = F.when(p % 3 == 0, other).when(p % 3 == 1, F.col("url"))
    return pages(spark, sf).select("page_id", "url", final.alias("final_url"))
