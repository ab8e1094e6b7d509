"""Streams give what the batch operators give."""

from pyspark.sql import functions as F

from linkloom.operators import frontier as fr
from linkloom.operators import links as K
from linkloom.session import fresh_path
from linkloom.streaming import live
from linkloom.workload import derive as D


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def split_stream(spark, df, parts):
    """``df`` as a stream of several files, one per batch."""
    path = fresh_path(spark, "in")
    df.repartition(parts).write.parquet(path)
    return live.read_stream(spark, path, "*.parquet", max_files=1)


def test_totals_over_several_batches(spark, small):
    log = D.stored_log(spark, small).select("log", "status", "bytes", "url", "domain", "ts")
    got = live.live_totals(split_stream(spark, log, 4))
    want = log.groupBy("log").agg(
        F.count("*"), F.sum("bytes"), F.count_if(F.col("status") == 404), F.count_if(F.col("status") == 403)
    )
    assert rows(got) == rows(want)


def test_dedupe_over_several_batches(spark, small):
    log = D.stored_log(spark, small).select("url", "ts")
    want = rows(log.select("url").distinct())
    assert rows(live.live_visited(split_stream(spark, log, 4))) == want
    timed = log.withColumn("ts", F.col("ts").cast("timestamp"))
    bounded = live.live_visited(split_stream(spark, timed, 4), within=("ts", "3650 days"))
    assert rows(bounded) == want


def test_domain_state(spark, small):
    log = D.stored_log(spark, small).select("domain", "status")
    got = live.live_domains(split_stream(spark, log, 3), 5)
    blocked = {r.domain for r in got.filter("blocked").collect()}
    assert blocked == {r.domain for r in fr.failing_domains(log, 5).collect()}
    assert got.agg(F.sum("pages")).first()[0] == log.count()


def test_links(spark, small):
    pages = D.pages(spark, small)
    assert rows(live.live_links(split_stream(spark, pages, 3))) == rows(K.extract_links(pages))


def test_sightings_let_their_state_go(spark):
    """One file per day, in order: state holds a few days' URLs however long the stream is."""
    path = fresh_path(spark, "days")
    for day in range(12):
        at = (F.lit(f"2024-01-{day + 1:02d} 00:00:00").cast("timestamp") + F.expr("make_dt_interval(0, 0, id % 1440)")).alias("ts")
        spark.range(300).select(F.concat(F.lit("u"), F.col("id") % 100).alias("url"), at).coalesce(1).write.mode("append").parquet(path)
    batches = []
    stream = live.read_stream(spark, path, "*.parquet", max_files=1)
    got = live.live_sightings(stream, "ts", "1 day", "12 hours", batches)
    assert got.count() == got.distinct().count() == 12 * 100
    assert len(batches) >= 12 and max(b.state_rows for b in batches) <= 300
    assert sum(b.late_rows for b in batches) == 0


def test_late_copies(spark):
    """On time or late, a copy gives no second row; a row whose window was let go is dropped and counted."""
    path = fresh_path(spark, "late")
    days = [
        [("a", "2024-01-01 01:00:00"), ("a", "2024-01-01 02:00:00"), ("b", "2024-01-01 03:00:00"), ("n", None)],
        [("a", "2024-01-02 12:00:00"), ("a", "2024-01-01 05:00:00")],  # late but within the delay
        [("c", "2024-01-09 00:00:00")],
        [("d", "2024-01-09 02:00:00")],  # the watermark that makes rows late is that of the batch before
        [("a", "2024-01-01 04:00:00"), ("z", "2024-01-01 04:00:00"), ("c", "2024-01-09 01:00:00")],  # let go by now
    ]
    for rows_ in days:
        df = spark.createDataFrame(rows_, "url string, at string").select("url", F.col("at").cast("timestamp").alias("ts"))
        df.coalesce(1).write.mode("append").parquet(path)
    batches = []
    got = live.live_sightings(live.read_stream(spark, path, "*.parquet", max_files=1), "ts", "1 day", "2 days", batches)
    assert sorted((r.url, str(r.since)[:10]) for r in got.collect()) == [
        ("a", "2024-01-01"), ("a", "2024-01-02"), ("b", "2024-01-01"), ("c", "2024-01-09"), ("d", "2024-01-09"),
    ]
    assert sum(b.late_rows for b in batches) == 2
    assert batches[-1].state_rows < 4


def test_table_of_one_file_or_of_many(spark, tmp_path):
    links = [(i, f"http://h{i}/", f'<a href="/{i}">x</a>') for i in range(40)]
    pages = spark.createDataFrame(links, "page_id long, url string, html string")
    pages.repartition(4).write.parquet(f"{tmp_path}/many/pages.parquet")
    pages.limit(3).write.parquet(f"{tmp_path}/many/other.parquet")
    pages.coalesce(1).write.parquet(f"{tmp_path}/made")
    (one,) = (tmp_path / "made").glob("part-*.parquet")
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "pages.parquet").write_bytes(one.read_bytes())
    pages.withColumn("day", F.col("page_id") % 3).write.partitionBy("day").parquet(f"{tmp_path}/days/pages.parquet")
    want = [(i, 0, f"http://h{i}/{i}") for i in range(40)]
    for folder in ("many", "one"):
        stream = live.read_stream(spark, f"{tmp_path}/{folder}", "pages.parquet", max_files=3)
        assert rows(live.live_links(stream).select("page_id", "pos", "dst")) == sorted(want, key=repr)
    days = live.live_visited(live.read_stream(spark, f"{tmp_path}/days", "pages.parquet").filter("day = 1"))
    assert days.count() == 13
