"""Many crawl logs at once: a log that cannot be read to its end does not stop the others.

Part of a log is no log. Lines are therefore written to the shared folder in one pass, and count only when
that pass has read every file to its end. When it fails, Spark names the file; that log is set aside with the
reason, and the rest is read again in two halves, so a few bad logs among many cost a few passes and
no line of a bad log is ever seen. Everything is read through Spark, on whatever store the logs lie.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import fresh_path
from linkloom.sources import crawl_log as L

FAILED_SCHEMA = "path string, log string, reason string, message string"
LINES_SCHEMA = "log string, ord struct<file:string,block:bigint,row:bigint>, line string"


@dataclass
class LogSet:
    """``lines`` (``log, ord, line``) of the logs that were read whole, and one row per other log:
    ``path, log, reason`` (``missing``, ``empty`` or ``damaged``) and ``message``."""

    lines: DataFrame
    failed: DataFrame


def _said(error: Exception) -> tuple[str | None, str]:
    """The file that Spark names, if any, and the innermost message."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    if cause is None:
        return None, str(error).splitlines()[0]
    file = None
    while cause is not None:
        if is_instance_of(SparkContext._gateway, cause, "org.apache.spark.SparkThrowable"):
            file = file or cause.getMessageParameters().get("path")
        last, cause = cause, cause.getCause()
    return file, f"{last.getClass().getSimpleName()}: {last.getMessage()}"


def _log_of(path: str) -> str:
    """The name that ``log_lines`` gives a log: its ``log=`` folder, else the file's name."""
    last = path.rstrip("/").rsplit("/", 1)[-1]
    return last[4:] if last.startswith("log=") else last.rsplit(".", 1)[0]


def whole_logs(spark: SparkSession, paths: str | list[str]) -> LogSet:
    """Logs of ``paths``, one file, folder or glob each; a path that is given twice is read once.

    Good logs are read once if all are good. A missing path, a folder without files and a log of which
    any file cannot be read to its end give a row in ``failed`` and not a single line.
    """
    wanted = list(dict.fromkeys([paths] if isinstance(paths, str) else paths))
    files: dict[str, list[str]] = {}
    failed: list[tuple[str, str, str, str]] = []
    for path in wanted:
        try:
            files[path] = spark.read.text(path).inputFiles()
        except AnalysisException as error:
            failed.append((path, _log_of(path), "missing", str(error).splitlines()[0]))
            continue
        if not files[path]:
            failed.append((path, _log_of(path), "empty", "no files"))
            del files[path]
    stored, rest = [], [list(files)] if files else []
    while rest:
        some = rest.pop()
        target = fresh_path(spark, "log-lines")
        try:
            L.log_lines(spark, some, skip_missing=False)[0].write.parquet(target)
        except (Py4JJavaError, PySparkException, FileNotFoundError) as error:
            file, message = _said(error)
            bad = [p for p in some if len(some) == 1 or _same(file, files[p])]
            failed += [(p, _log_of(p), "damaged", message) for p in bad]
            left = [p for p in some if p not in bad]
            half = (len(left) + 1) // 2
            rest += [part for part in (left[:half], left[half:]) if part]
            continue
        stored.append(target)
    lines = spark.read.schema(LINES_SCHEMA).parquet(*stored) if stored else spark.createDataFrame([], LINES_SCHEMA)
    return LogSet(lines, spark.createDataFrame(failed, FAILED_SCHEMA))


def _same(file: str | None, files: list[str]) -> bool:
    """Whether Spark's error is about one of ``files``; schemes are written in several ways."""
    return file is not None and file.split(":", 1)[-1].lstrip("/") in {
        f.split(":", 1)[-1].lstrip("/") for f in files
    }


def log_states(logs: LogSet) -> DataFrame:
    """``log, state, n_rows, total_bytes``: every log, ``read`` with its totals or why it failed."""
    rows = L.log_rows(logs.lines)
    totals = rows.groupBy("log").agg(
        F.lit("read").alias("state"), F.count("*").alias("n_rows"), F.sum("bytes").alias("total_bytes")
    )
    none = F.lit(None).cast("bigint")
    bad = logs.failed.select("log", F.col("reason").alias("state"), none.alias("n_rows"), none.alias("total_bytes"))
    return totals.unionByName(bad)
