"""Live state of a running crawl with Structured Streaming.

Results go to Parquet in the shared folder, never to a driver-side sink. Every function drains what
is available and returns the result table; pass ``trigger`` to keep a query running instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from linkloom.functions.metrics import at_least_zero, is_backoff_status
from linkloom.operators.frontier import BACKOFF_FAILURES
from linkloom.operators.links import listed, with_links
from linkloom.session import fresh_path


def read_stream(spark: SparkSession, folder: str, glob: str, max_files: int = 1000) -> DataFrame:
    """Parquet files of ``folder`` matching ``glob`` as a stream, schema taken from what is there.

    Where no file matches, ``glob`` names a folder in ``folder``: a table of many files.
    """
    options = {"pathGlobFilter": glob}
    try:
        schema = spark.read.options(**options).parquet(folder).schema
    except AnalysisException:
        folder, options = f"{folder}/{glob}", {}
        schema = spark.read.parquet(folder).schema
    reader = spark.readStream.schema(schema).options(**options)
    return reader.option("maxFilesPerTrigger", max_files).parquet(folder)


@dataclass
class Batch:
    """What one batch of a stream did to the state store."""

    rows_in: int
    state_rows: int
    late_rows: int


def _drain(writer: DataStreamWriter, state: str) -> list[Batch]:
    query = writer.option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return [
        Batch(
            p["numInputRows"],
            sum(o["numRowsTotal"] for o in p["stateOperators"]),
            sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]),
        )
        for p in query.recentProgress
    ]


def _to_parquet(stream: DataFrame, name: str, batches: list[Batch] | None = None) -> DataFrame:
    """Append sink: each row is written once, exactly. ``batches`` is told what each batch did."""
    spark = stream.sparkSession
    out, state = fresh_path(spark, name), fresh_path(spark, f"{name}-state")
    done = _drain(stream.writeStream.outputMode("append").format("parquet").option("path", out), state)
    if batches is not None:
        batches += done
    return spark.read.schema(stream.schema).parquet(out)


def _latest(
    stream: DataFrame, keys: list[str], name: str, finish: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Update sink: every batch writes the groups it changed, reading keeps each group's newest row.

    A batch folder is overwritten when its batch is retried, so a lost executor repeats no row.
    """
    spark = stream.sparkSession
    out, state = fresh_path(spark, name), fresh_path(spark, f"{name}-state")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _drain(stream.writeStream.outputMode("update").foreachBatch(save), state)
    values = [c for c in stream.columns if c not in keys]
    newest = (
        spark.read.parquet(out)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "batch").alias("_newest"))
        .select(*keys, "_newest.*")
    )
    return finish(newest)


def live_totals(rows: DataFrame) -> DataFrame:
    """Pages, bytes, 404s and 403s so far, per log."""
    totals = rows.groupBy("log").agg(
        F.count("*").alias("pages_crawled"),
        F.sum(at_least_zero(F.col("bytes"))).alias("total_bytes"),
        F.count_if(F.col("status") == 404).alias("num_404"),
        F.count_if(F.col("status") == 403).alias("num_403"),
    )
    return _latest(totals, ["log"], "live-totals", lambda df: df)


def live_visited(rows: DataFrame, within: tuple[str, str] | None = None) -> DataFrame:
    """Each URL once, when first seen.

    ``within=(time column, delay)`` bounds the state: copies of a URL that arrive within the delay
    are dropped and older state is let go. Without it every URL stays in the state store.
    """
    if within:
        column, delay = within
        urls = rows.select("url", column).withWatermark(column, delay)
        unique = urls.dropDuplicatesWithinWatermark(["url"]).select("url")
    else:
        unique = rows.select("url").dropDuplicates(["url"])
    return _to_parquet(unique, "live-visited")


def live_sightings(
    rows: DataFrame, time: str, every: str, delay: str, batches: list[Batch] | None = None
) -> DataFrame:
    """``url, since``: each URL once in every ``every`` of event time, when first seen there.

    Bounded state, the same rows however the stream is cut into batches: a URL is remembered until the
    watermark (the latest ``time`` less ``delay``) passes the end of its window, then let go. A copy in the
    same window gives no row, on time or late. A row is late when its window ended before the
    watermark of the batch before its own: it is dropped, also where its URL was not seen before, and
    counted in ``batches``. Rows without a time
    give none.
    """
    timed = rows.select("url", F.col(time).cast("timestamp").alias("at")).withWatermark("at", delay)
    windows = timed.select("url", F.window("at", every).alias("window"))
    unique = windows.dropDuplicates(["url", "window"])
    return _to_parquet(unique.select("url", F.col("window.start").alias("since")), "live-sightings", batches)


def live_domains(rows: DataFrame, threshold: int = BACKOFF_FAILURES) -> DataFrame:
    """Pages and failures per domain so far, and whether the domain is backed off."""
    state = rows.groupBy("domain").agg(
        F.count("*").alias("pages"),
        F.count_if(is_backoff_status(F.col("status"))).alias("failures"),
    )
    return _latest(
        state,
        ["domain"],
        "live-domains",
        lambda df: df.withColumn("blocked", F.col("failures") >= threshold),
    )


def live_links(
    pages: DataFrame, mode: str = "fast", key: str = "page_id", cap: int | None = None
) -> DataFrame:
    """Links of each page as it arrives: ``key, pos, dst``."""
    parsed = with_links(pages.select(key, "url", "html"), mode, cap=cap)
    links = listed(parsed, [key], "dst")
    return _to_parquet(links.withColumn("pos", F.col("pos").cast("bigint")), "live-links")
