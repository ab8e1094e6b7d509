"""Report figures, running totals and numbering against plain Python."""

import random
from statistics import median, quantiles

import pytest
from pyspark.sql import functions as F

from linkloom.functions import metrics as M
from linkloom.operators import frontier as fr
from linkloom.operators import ordering as O
from linkloom.operators import report as R
from linkloom.workload import derive as D


@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 99, 100, 101, 1000])
def test_percentiles_equal_the_library(spark, n):
    rng = random.Random(n)
    values = [rng.randint(0, 300) for _ in range(n)]
    df = spark.createDataFrame(
        [("a", True, v, v * 2, 5) for v in values],
        "log string, debug_ok boolean, t_connect_ms long, t_read_ms long, t_parse_ms long",
    )
    got = {r.phase: (r.p50, r.p95) for r in R.phase_percentiles(df).collect()}

    def want(xs):
        return int(median(xs)), int(quantiles(xs, n=100)[94]) if len(xs) > 1 else max(xs)

    assert got["t_connect_ms"] == want(values)
    assert got["t_read_ms"] == want([2 * v for v in values])
    assert got["t_parse_ms"] == (5, 5)


def test_no_debug_rows_no_percentiles(spark):
    df = spark.createDataFrame(
        [("a", False, 1, 1, 1)],
        "log string, debug_ok boolean, t_connect_ms long, t_read_ms long, t_parse_ms long",
    )
    assert R.phase_percentiles(df).count() == 0


def test_status_counts_sum_to_rows(spark, small):
    log = D.stored_log(spark, small)
    pages = R.totals(log)
    n = R.status_distribution(log, pages, k=100).agg(F.sum("n")).first()[0]
    assert n == log.count()
    shares = R.status_distribution(log, pages, k=100).groupBy("log").agg(F.sum("share_pct").alias("s"))
    assert all(r.s == pytest.approx(100) for r in shares.collect())


def test_top_list_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a", d) for d in "ccbbaad"], "log string, domain string")
    got = [(r["rank"], r.domain, r.n) for r in R.top_domains(df, 3).orderBy("rank").collect()]
    assert got == [(1, "a", 2), (2, "b", 2), (3, "c", 2)]


def test_human_bytes(spark):
    def shown(n):
        value = float(n)
        for unit in ("B", "KB", "MB", "GB", "TB"):
            if value < 1024 or unit == "TB":
                return f"{value:.1f} {unit}"
            value /= 1024

    rng = random.Random(3)
    sizes = [0, 1, 1023, 1024, 1280, 1331, 1075, 94067, 473443930, 2**20 - 1, 2**40, 2**52, 256 * 5, 1024 * 1.25 * 2**10]
    sizes = [int(s) for s in sizes] + [rng.randint(0, 2 ** rng.randint(1, 52)) for _ in range(500)]
    sizes += [k * 2**10 // 20 for k in range(1, 400)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i int, n long")
    got = [r.t for r in df.select("i", M.human_bytes(F.col("n")).alias("t")).orderBy("i").collect()]
    assert got == [shown(s) for s in sizes]


def rows_with_hot_domain(spark, n=400, seed=1):
    """Every second row is of one domain."""
    rng = random.Random(seed)
    hosts = ["hot.x.com"] * 5 + ["a.x.com", "b.y.com", "c.y.com", "", "d.z.com"]
    data = [(f"run{rng.randint(0, 1)}", i, rng.choice(hosts), rng.choice([200, 200, 404, 500])) for i in range(n)]
    df = spark.createDataFrame(data, "log string, seq long, domain string, status int")
    return data, df.withColumn("superdomain", F.substring_index("domain", ".", -2))


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_running_counts_do_not_depend_on_the_block(spark, block):
    data, df = rows_with_hot_domain(spark)
    want, counts, supers = {}, {}, {}
    for log, seq, domain, _ in data:
        top = ".".join(domain.split(".")[-2:])
        counts[log, domain] = counts.get((log, domain), 0) + 1
        supers[log, top] = supers.get((log, top), 0) + 1
        want[seq] = counts[log, domain], supers[log, top]
    got = O.running_domain_counts(df, "seq", block).collect()
    assert {r.seq: (r.domain_count, r.super_count) for r in got} == want
    assert len(got) == len(data)


def test_running_backoff(spark):
    data, df = rows_with_hot_domain(spark)
    fails, want = {}, {}
    for log, seq, domain, status in data:
        earlier = fails.get((log, domain), 0)
        want[seq] = earlier, earlier >= 5
        fails[log, domain] = earlier + (status == 500)
    got = O.running_backoff(df, F.col("status") == 500, block=50).collect()
    assert {r.seq: (r.earlier_failures, r.blocked) for r in got} == want


def test_window_tasks_hold_one_block(spark):
    _, df = rows_with_hot_domain(spark)
    sizes = df.withColumn("b", F.floor(F.col("seq") / 50)).groupBy("log", "domain", "b").count()
    assert sizes.agg(F.max("count")).first()[0] <= 50


def test_numbering_is_the_global_order(spark):
    rng = random.Random(5)
    data = [(rng.randint(0, 3) * 1.0, i) for i in range(500)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k double, i int").repartition(7)
    got = O.numbered(df, ["k", "i"]).collect()
    assert {r["rank"]: (r.k, r.i) for r in got} == dict(enumerate(sorted(data), 1))
    assert O.numbered(df.filter("false"), ["k", "i"]).count() == 0


def test_page_budget_is_exact(spark, small):
    items = fr.first_per_url(D.queue_items(spark, small))
    total = items.count()
    for n in (0, 1, 17, total, total + 5):
        kept = fr.page_budget(items, n)
        assert kept.count() == min(n, total)


def test_first_per_url_is_the_least(spark, small):
    items = D.queue_items(spark, small).collect()
    best = {}
    for r in items:
        key = (r.priority, r.depth, r.seq)
        best[r.url] = min(best.get(r.url, key), key)
    got = {r.url: (r.priority, r.depth, r.seq) for r in fr.first_per_url(D.queue_items(spark, small)).collect()}
    assert got == best


def test_unread_stat_is_zero_percent(spark):
    df = spark.createDataFrame([(5, 0)], "x int, y int")
    assert df.select(M.percent(F.col("x"), F.col("y"))).first()[0] == 0.0


def test_backoff_set(spark):
    df = spark.createDataFrame([(s,) for s in (429, 417, 403, 401, 500, 0, 404, 503, 999, 200)], "status int")
    got = {r.status for r in df.filter(M.is_backoff_status(F.col("status"))).collect()}
    assert got == {429, 417, 403, 401, 500, 0}


def test_running_totals_keep_rows_without_a_group(spark):
    rows = [(None, 1, 5), (None, 2, 6), ("a", 1, 7), (None, 700, 1)]
    df = spark.createDataFrame(rows, "host string, seq int, v int")
    out = O.running_totals(df, ["host"], "seq", {"total": F.col("v")}, block=500).collect()
    assert sorted((r.host or "", r.seq, r.total) for r in out) == [("", 1, 5), ("", 2, 11), ("", 700, 12), ("a", 1, 7)]
