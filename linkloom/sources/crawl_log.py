"""Crawl logs: tab-separated text in, typed rows out, and the matching writers.

Lines are read as text and split, not through the CSV source: rows vary in width, and the width
decides what a row is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from linkloom.functions.metrics import at_least_zero, log_time
from linkloom.sources.seeds import read_lines

# Columns of a crawl log in file order; the debug tail is optional.
CORE_COLUMNS = (
    "timestamp", "url", "status", "bytes", "depth", "priority",
    "domain", "domain_count", "superdomain", "super_count", "elapsed_ms",
)
DEBUG_COLUMNS = (
    "ct", "t_connect_ms", "t_read_ms", "t_parse_ms",
    "links_found", "links_enqueued", "html_truncated",
)

# Run totals a log ends with, in file order.
STAT_KEYS = (
    "pages_crawled", "total_bytes", "elapsed_sec", "rate_pages_per_sec", "num_404", "num_403",
)

# Columns of the run summary, one row per log.
SUMMARY_SCHEMA = (
    "log string, pages bigint, total_success bigint, total_failure bigint,"
    " success_rate_pct double, total_bytes bigint, elapsed_sec double, rate_official double,"
    " rate_recomputed double, num_404 bigint, num_403 bigint"
)

_QUOTED_FIELDS = r'(?:^|\t)("(?:[^"]|"")*+"?[^\t]*|[^\t]*)'


def fields_of(line: Column) -> Column:
    """Fields of a tab-separated line; a field that starts with a quote is unquoted."""
    quoted = F.transform(
        F.regexp_extract_all(line, F.lit(_QUOTED_FIELDS), 1),
        lambda f: F.when(
            f.startswith('"'),
            F.regexp_replace(
                F.regexp_replace(f, r'^"((?:[^"]|"")*+)"?([^\t]*)$', "$1$2"), '""', '"'
            ),
        ).otherwise(f),
    )
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, "\t", -1))


def log_lines(
    spark: SparkSession, paths: str | list[str], skip_missing: bool = True
) -> tuple[DataFrame, list[str]]:
    """Lines of one or several logs as ``log, ord, line``, and the paths that could not be read.

    The log's name is the ``log`` partition folder if there is one, else the file name without
    extension. A log that is missing does not stop the others; it is listed in what is
    returned second.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    found, skipped = [], []
    for path in wanted:
        try:
            spark.read.text(path)
            found.append(path)
        except AnalysisException:
            if not skip_missing:
                raise
            skipped.append(path)
    if not found:
        raise FileNotFoundError(", ".join(wanted))
    # A file that is damaged, or goes while it is read, fails the job: part of a log is no log.
    reader = spark.read.option("ignoreCorruptFiles", False).option("ignoreMissingFiles", False)
    file = F.col("_metadata.file_path")
    folder = F.regexp_extract(file, r"/log=([^/]*)/", 1)
    name = F.regexp_extract(file, r"([^/]*?)(?:\.[^./]*)?$", 1)
    lines = reader.text(found).select(
        F.when(folder != "", folder).otherwise(name).alias("log"),
        F.struct(
            file.alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"),
        F.col("value").alias("line"),
    )
    return lines, skipped


def classify(lines: DataFrame) -> DataFrame:
    """Add ``fields`` and ``kind``: empty, stat, header, malformed or valid."""
    out = lines.withColumn("fields", fields_of(F.col("line")))
    first = F.get("fields", F.lit(0))
    typed = (
        F.get("fields", F.lit(3)).try_cast("bigint").isNotNull()
        & F.get("fields", F.lit(10)).try_cast("bigint").isNotNull()
    )
    kind = (
        F.when(F.col("line") == "", "empty")
        .when(first == "STAT", "stat")
        .when(first == "timestamp", "header")
        .when(typed, "valid")
        .otherwise("malformed")
    )
    return out.withColumn("kind", kind)


def row_quality(lines: DataFrame) -> DataFrame:
    """Lines per log and kind."""
    return classify(lines).groupBy("log", "kind").agg(F.count("*").alias("n_lines"))


def _field(i: int) -> Column:
    return F.get("fields", F.lit(i))


def _core(lines: DataFrame) -> list[Column]:
    return [
        *[F.col(c) for c in lines.columns if c not in ("line", "fields", "kind")],
        _field(0).try_cast("timestamp_ntz").alias("ts"),
        _field(1).alias("url"),
        _field(2).alias("status"),
        at_least_zero(_field(3).try_cast("bigint")).alias("bytes"),
        _field(4).try_cast("int").alias("depth"),
        _field(5).try_cast("double").alias("priority"),
        _field(6).alias("domain"),
        _field(7).try_cast("bigint").alias("domain_count"),
        _field(8).alias("superdomain"),
        _field(9).try_cast("bigint").alias("super_count"),
        at_least_zero(_field(10).try_cast("bigint")).alias("elapsed_ms"),
    ]


def log_rows(lines: DataFrame) -> DataFrame:
    """Typed rows of the valid lines, core columns only; any status text is kept."""
    valid = classify(lines).filter(F.col("kind") == "valid")
    return valid.select(*_core(valid))


def log_rows_with_debug(lines: DataFrame) -> DataFrame:
    """Core columns plus the debug tail.

    The tail is the last six fields of a row of 18 or more; if one of them is no integer the whole
    tail is NULL and ``debug_ok`` false, while the core stays.
    """
    valid = classify(lines).filter(F.col("kind") == "valid")
    names = DEBUG_COLUMNS[1:]
    cast = {
        name: F.try_element_at("fields", F.lit(i - len(names))).try_cast("bigint")
        for i, name in enumerate(names)
    }
    ok = F.size("fields") >= len(CORE_COLUMNS) + len(DEBUG_COLUMNS)
    for value in cast.values():
        ok = ok & value.isNotNull()
    tail = [
        F.when(F.col("debug_ok"), at_least_zero(F.col(name))).alias(name) for name in names[:-1]
    ]
    flag = F.when(F.col("debug_ok"), (F.col(names[-1]) != 0).cast("int")).alias(names[-1])
    core = _core(valid)
    wide = valid.select(*core, *[v.alias(k) for k, v in cast.items()], ok.alias("debug_ok"))
    keep = [c for c in wide.columns if c not in names]
    return wide.select(*keep, *tail, flag)


def log_rows_lenient(lines: DataFrame) -> DataFrame:
    """Rows whose status, bytes and elapsed time are all integers; status is an INT here."""
    rows = log_rows(lines).withColumn("status", F.col("status").try_cast("int"))
    return rows.filter(F.col("status").isNotNull())


def stat_values(lines: DataFrame) -> DataFrame:
    """Run totals of each log as ``log, key, value``; the last line of a key wins."""
    stat = classify(lines).filter((F.col("kind") == "stat") & (F.size("fields") >= 3))
    return (
        stat.select("log", "ord", _field(1).alias("key"), _field(2).alias("value"))
        .groupBy("log", "key")
        .agg(F.max_by("value", "ord").alias("value"))
    )


def log_text(rows: DataFrame, debug: bool = True) -> DataFrame:
    """Rows as the text columns of a log file, in file order."""
    columns = [*CORE_COLUMNS, *(DEBUG_COLUMNS if debug else ())]
    shaped = rows.withColumns(
        {
            "timestamp": log_time(F.col("ts")),
            "priority": F.format_string("%.6f", F.col("priority")),
        }
    )
    lead = [c for c in ("log",) if c in rows.columns]
    return shaped.select(*lead, *[F.col(c).cast("string").alias(c) for c in columns])


def write_log(
    rows: DataFrame,
    path: str,
    debug: bool = True,
    mode: str = "errorifexists",
    compression: str = "none",
) -> None:
    """Write rows as tab-separated logs with a header, one ``log=`` folder per log if there are several."""
    text = log_text(rows, debug)
    writer = text.write.mode(mode).options(
        sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression,
    )
    if "log" in rows.columns:
        writer = writer.partitionBy("log")
    writer.csv(path)


def stat_rows(stats: DataFrame) -> DataFrame:
    """Totals, one row per log, as the STAT rows of a log: ``log, key, value`` text."""
    pairs = ", ".join(
        f"'{key}', format_string('{fmt}', {key})"
        for key, fmt in zip(STAT_KEYS, ("%d", "%d", "%.3f", "%.2f", "%d", "%d"))
    )
    return stats.select("log", F.expr(f"stack({len(STAT_KEYS)}, {pairs}) AS (key, value)"))


def write_stat_rows(stats: DataFrame, path: str, mode: str = "append") -> None:
    """Append the STAT rows to a log folder as lines of their own."""
    rows = stat_rows(stats).select(
        "log", F.concat_ws("\t", F.lit("STAT"), F.col("key"), F.col("value")).alias("value")
    )
    rows.write.mode(mode).partitionBy("log").text(path)


def append_summary(summary: DataFrame, path: str) -> None:
    """Append run-summary rows under the declared schema; earlier runs stay as they are."""
    schema = summary.sparkSession.createDataFrame([], SUMMARY_SCHEMA).schema
    typed = summary.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    typed.write.mode("append").parquet(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).parquet(path)


__all__ = [
    "append_summary", "classify", "fields_of", "log_lines", "log_rows", "log_rows_lenient",
    "log_rows_with_debug", "log_text", "read_lines", "read_summary", "row_quality", "stat_rows",
    "stat_values", "write_log", "write_stat_rows",
]
