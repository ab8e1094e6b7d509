"""Log lines, their readers and writers."""

import pytest
from pyspark.sql import functions as F

from linkloom.operators import report as R
from linkloom.plans import report as PR
from linkloom.session import fresh_path
from linkloom.sources import crawl_log as L
from linkloom.sources import seeds as S

CORE = "2024-01-01 00:00:00\thttp://h/\t{st}\t{by}\t1\t0.998700\th\t1\th\t1\t{el}"
DEBUG = "\ttext/html\t5\t6\t7\t8\t9\t{tr}"


def row(st="200", by="10", el="20", tr=None, extra=""):
    return (CORE + (DEBUG if tr is not None else "")).format(st=st, by=by, el=el, tr=tr) + extra


def lines(spark, *texts, log="a"):
    return spark.createDataFrame([(log, i, t) for i, t in enumerate(texts)], "log string, ord int, line string")


def test_kinds(spark):
    df = lines(spark, "", "STAT\tx", "timestamp\turl", row(), "a\tb", row(by="n/a"), row(el="x"), "  ")
    got = [r.kind for r in L.classify(df).orderBy("ord").collect()]
    assert got == ["empty", "stat", "header", "valid", "malformed", "malformed", "malformed", "malformed"]


def test_core_rows(spark):
    got = L.log_rows(lines(spark, row(by="-5", st="abc", el=" 7 "))).first()
    assert (got.status, got.bytes, got.elapsed_ms, got.priority) == ("abc", 0, 7, 0.9987)
    assert str(got.ts) == "2024-01-01 00:00:00"


def test_debug_tail(spark):
    df = lines(spark, row(tr="1"), row(tr="x"), row(), row(tr="0", extra="\t7"))
    got = L.log_rows_with_debug(df).orderBy("ord").collect()
    assert [r.debug_ok for r in got] == [True, False, False, True]
    assert (got[0].t_connect_ms, got[0].links_enqueued, got[0].html_truncated) == (5, 9, 1)
    assert got[1].t_connect_ms is None
    # One field more: the last six fields are read, so everything moves by one.
    assert (got[3].t_connect_ms, got[3].links_enqueued, got[3].html_truncated) == (6, 0, 1)


def test_quoted_fields(spark):
    text = 'a\t"x ""y"" z"\t"p\tq"\tb"c\t"tail"end'
    got = spark.createDataFrame([(text,)], "l string").select(L.fields_of(F.col("l"))).first()[0]
    assert got == ["a", 'x "y" z', "p\tq", 'b"c', "tailend"]


def test_lenient_reader_needs_integer_status(spark):
    got = L.log_rows_lenient(lines(spark, row(st="abc"), row(st="404"))).collect()
    assert [r.status for r in got] == [404]


def test_last_stat_wins_and_short_ones_are_ignored(spark):
    df = lines(spark, "STAT\tk\t1", "STAT\tk\t2", "STAT\tk", "STAT\tj\tx\ty")
    got = {r.key: r.value for r in L.stat_values(df).collect()}
    assert got == {"k": "2", "j": "x"}


def test_overlay(spark):
    df = lines(spark, row(), row(st="404"), "STAT\tpages_crawled\t7.9", "STAT\ttotal_bytes\tn/a",
               "STAT\tnum_404\tnan")
    got = R.stat_overlay(L.log_rows(df), L.stat_values(df)).first()
    assert (got.pages_crawled, got.total_bytes, got.num_404, got.elapsed_sec) == (7, 20, 0, 0.0)
    ok = R.success(R.stat_overlay(L.log_rows(df), L.stat_values(df))).first()
    assert (ok.pages, ok.total_success, ok.total_failure) == (7, 1, 6)
    assert ok.success_rate_pct == pytest.approx(100 / 7)


def test_zero_stat_pages_fall_back_to_rows(spark):
    df = lines(spark, row(), "STAT\tpages_crawled\t0")
    ok = R.success(R.stat_overlay(L.log_rows(df), L.stat_values(df))).first()
    assert (ok.pages, ok.total_failure) == (1, 0)


def test_log_without_rows_is_reported(spark):
    df = lines(spark, "timestamp\turl", "STAT\telapsed_sec\t411.059")
    got = PR.report_of_lines(df).summary.first()
    assert (got.pages, got.total_success, got.success_rate_pct) == (0, 0, 0.0)
    assert (got.elapsed_sec, got.rate_recomputed, got.avg_bytes) == (411.059, 0.0, 0)


def test_written_log_reads_back(spark):
    rows = L.log_rows_with_debug(lines(spark, row(tr="1"), row(st="0", tr="0"))).withColumn(
        "ct", F.when(F.col("status") == "0", "").otherwise('text/html; charset="utf-8"')
    )
    path = fresh_path(spark, "t")
    L.write_log(rows, path)
    L.write_stat_rows(R.crawl_stats(rows.withColumn("status", F.col("status").cast("int"))), path)
    back, skipped = L.log_lines(spark, [f"{path}/log=a", f"{path}/log=missing"])
    assert skipped == [f"{path}/log=missing"]
    assert {r.log for r in back.select("log").distinct().collect()} == {"a"}
    got = L.log_rows_with_debug(back)
    keep = [c for c in rows.columns if c not in ("ord", "ct")]
    assert sorted(map(tuple, got.select(*keep).collect())) == sorted(map(tuple, rows.select(*keep).collect()))
    stats = {r.key: r.value for r in L.stat_values(back).collect()}
    assert list(stats) and stats["pages_crawled"] == "2" and stats["elapsed_sec"] == "0.000"
    types = [L.fields_of(F.col("line")).getItem(11).alias("ct")]
    assert 'text/html; charset="utf-8"' in {r.ct for r in back.filter("size(split(line, '\t')) > 17").select(*types).collect()}


def test_line_order_of_a_file(spark, tmp_path):
    path = tmp_path / "one.tsv"
    path.write_text("".join(f"STAT\tk\t{i}\n" for i in range(500)))
    back, _ = L.log_lines(spark, str(path))
    got = L.stat_values(back).first()
    assert (got.log, got.value) == ("one", "499")


def test_no_readable_log(spark):
    with pytest.raises(FileNotFoundError):
        L.log_lines(spark, "/tmp/none-such-log.tsv")


def test_summary_appends(spark, small):
    path = fresh_path(spark, "s")
    one = spark.createDataFrame([("a", 1, 1, 0, 100.0, 5, 1.0, 1.0, 2.0, 0, 0)], L.SUMMARY_SCHEMA)
    L.append_summary(one, path)
    L.append_summary(one, path)
    assert L.read_summary(spark, path).count() == 2


def test_seeds(spark):
    texts = ["# comment", "", "  https://a.example.com/  ", "https://b.example.com/x  # note",
             "https://b.example.com/x", "   ", "example.com"]
    df = spark.createDataFrame(list(enumerate(texts)), "ord int, line string")
    got = [(r.ord, r.url) for r in S.seeds(df).orderBy("ord").collect()]
    assert got == [(2, "https://a.example.com/"), (3, "https://b.example.com/x  # note"),
                   (4, "https://b.example.com/x"), (6, "example.com")]
    clean = [r.url for r in S.seeds(df, strip_inline_comments=True).orderBy("ord").collect()]
    assert clean[1] == "https://b.example.com/x"


def test_seed_file_order(spark, tmp_path):
    path = tmp_path / "seeds.txt"
    path.write_text("".join(f"https://h{i}.com/\n" for i in range(50)))
    got = [r.url for r in S.seeds(S.read_lines(spark, str(path))).orderBy("ord").collect()]
    assert got == [f"https://h{i}.com/" for i in range(50)]
