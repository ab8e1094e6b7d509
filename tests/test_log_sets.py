"""Many logs at once: good ones whole, each bad one a row, nothing of a bad one in any total."""

import gzip

import pytest
from pyspark.sql import functions as F

from linkloom.plans import report as PR
from linkloom.sources import crawl_log as L
from linkloom.sources import log_sets as LS
from linkloom.workload import derive as D

ROW = "2024-01-01 00:00:0{s}\thttp://h{n}/\t200\t{n}\t1\t0.9\th\t1\th\t1\t20"


def text(n, rows=2000):
    return "\n".join(ROW.format(s=i % 10, n=n) for i in range(rows)) + f"\nSTAT\tpages_crawled\t{rows}\n"


@pytest.fixture
def folder(tmp_path):
    for n in range(6):
        (tmp_path / f"good{n}.tsv").write_text(text(n + 1))
    whole = gzip.compress(text(50).encode())
    (tmp_path / "zipped.gz").write_bytes(whole)
    (tmp_path / "cut.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "late.gz").write_bytes(whole[:-4])  # all lines can be read, the end cannot
    (tmp_path / "other.gz").write_bytes(text(60).encode())
    mixed = tmp_path / "log=mixed"
    mixed.mkdir()
    (mixed / "a.tsv").write_text(text(70))
    (mixed / "b.gz").write_bytes(whole[:60])
    (tmp_path / "log=bare").mkdir()
    return tmp_path


def test_bad_logs_stand_apart(spark, folder):
    names = ["good0.tsv", "cut.gz", "good1.tsv", "late.gz", "zipped.gz", "other.gz", "log=mixed", "good2.tsv", "gone.tsv", "log=bare"]
    logs = LS.whole_logs(spark, [f"{folder}/{n}" for n in names])
    failed = {r.log: r.reason for r in logs.failed.collect()}
    assert failed == {
        "cut": "damaged", "late": "damaged", "other": "damaged", "mixed": "damaged", "gone": "missing", "bare": "empty",
    }
    assert all(r.message and r.path.startswith(str(folder)) for r in logs.failed.collect())
    counted = {r.log: r.n for r in logs.lines.groupBy("log").agg(F.count("*").alias("n")).collect()}
    assert counted == {"good0": 2001, "good1": 2001, "good2": 2001, "zipped": 2001}
    states = {r.log: (r.state, r.n_rows, r.total_bytes) for r in LS.log_states(logs).collect()}
    assert states["zipped"] == ("read", 2000, 100_000) and states["cut"] == ("damaged", None, None)


def test_all_good_is_one_pass(spark, folder, monkeypatch):
    passes = []
    whole = L.log_lines
    monkeypatch.setattr(L, "log_lines", lambda *a, **k: passes.append(a) or whole(*a, **k))
    paths = [f"{folder}/good{n}.tsv" for n in range(6)]
    logs = LS.whole_logs(spark, [*paths, paths[0]])
    assert logs.failed.count() == 0 and logs.lines.count() == 6 * 2001 and len(passes) == 1


def test_one_bad_among_many_costs_few_passes(spark, folder, monkeypatch):
    passes = []
    whole = L.log_lines
    monkeypatch.setattr(L, "log_lines", lambda *a, **k: passes.append(a) or whole(*a, **k))
    paths = [f"{folder}/good{n}.tsv" for n in range(6)] + [f"{folder}/cut.gz"]
    assert LS.whole_logs(spark, paths).lines.count() == 6 * 2001 and len(passes) == 3


def test_none_good_and_none_at_all(spark, folder):
    logs = LS.whole_logs(spark, [f"{folder}/cut.gz", f"{folder}/gone.tsv"])
    assert logs.lines.collect() == [] and logs.failed.count() == 2
    assert LS.whole_logs(spark, []).lines.collect() == []


def test_report_of_good_logs(spark, folder, tmp_path):
    paths = [f"{folder}/{n}" for n in ("good0.tsv", "cut.gz", "good3.tsv")]
    summary = str(tmp_path / "summary")
    report, failed = PR.report_logs(spark, paths, summary)
    assert {r.log: (r.pages, r.total_bytes) for r in report.summary.collect()} == {
        "good0": (2000, 2000), "good3": (2000, 8000),
    }
    assert [r.log for r in failed.collect()] == ["cut"]
    PR.report_logs(spark, paths[1:], summary)
    back = sorted(r.log for r in L.read_summary(spark, summary).collect())
    assert back == ["good0", "good3", "good3"]


def test_damaged_logs_have_files_as_their_rows_ask(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "FILE_ROWS", 100, raising=False)
    pages = [(i, f"http://h{i}.example/", "<a href='/x'>x</a>") for i in range(5)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.range(1000).selectExpr(
        "id AS event_id", "timestamp_seconds(id) AS ts", "id AS user_id", "'view' AS event_type", "1.5D AS value"
    ).write.parquet(f"{tmp_path}/events.parquet")
    paths = D.damaged_logs(spark, str(tmp_path), 50)
    for name in ("run0", "run1", "run2"):
        (path,) = [p for p in paths if p.endswith(f"log={name}")]
        lines = spark.read.text(path)
        assert len(lines.inputFiles()) == 10
        most = lines.groupBy(F.col("_metadata.file_path").alias("f")).count().agg(F.max("count")).first()[0]
        assert most < 100
    states = {r.log: (r.state, r.n_rows) for r in LS.log_states(LS.whole_logs(spark, paths)).collect()}
    assert states == {
        "run0": ("read", 334), "run1": ("read", 333), "run2": ("read", 333),
        "cut": ("damaged", None), "plain": ("damaged", None), "empty": ("empty", None), "none": ("missing", None),
    }
