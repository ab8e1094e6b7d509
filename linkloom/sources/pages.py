"""Page snapshots: the table that stands in for fetched bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.metrics import HTML_PREFIX
from linkloom.functions.urls import canonical_url
from linkloom.session import own_side


def enough_tasks(df: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than cores (small files, one row group) over all cores.

    A table with more splits than cores, which is every large one, is returned untouched: bodies
    are never shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return enough_tasks(spark.read.parquet(path))


def snapshot(
    pages: DataFrame,
    url: str = "url",
    body: str = "html",
    status: int = 200,
    content_type: str = HTML_PREFIX,
) -> DataFrame:
    """Pages with the attributes of a fetch; absent columns get the defaults of a good fetch.

    ``bytes`` defaults to the body's byte length. A ``final_url``, where a redirect led, is optional: it is
    kept if it is there and not made up if it is not.
    """
    have = set(pages.columns)
    defaults: dict[str, Column] = {
        "status": F.lit(status),
        "ct": F.lit(content_type),
        "bytes": F.octet_length(F.col(body)).cast("bigint"),
        "elapsed_ms": F.lit(0).cast("bigint"),
    }
    return pages.withColumns({k: v for k, v in defaults.items() if k not in have})


def lookup(candidates: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """Fetch attributes of each candidate URL; one without a page has status 0, no bytes, no type.

    ``pages`` is keyed by ``url``; of several rows for one URL the first by ``page_id`` answers. Only
    the narrow attributes travel, never the body.
    """
    first = pages.groupBy(url).agg(
        F.min_by(F.struct("status", "bytes", "ct", "elapsed_ms"), "page_id").alias("hit")
    )
    return candidates.join(own_side(first), url, "left").select(
        *candidates.columns,
        F.coalesce("hit.status", F.lit(0)).alias("status"),
        F.coalesce("hit.bytes", F.lit(0).cast("bigint")).alias("bytes"),
        F.coalesce("hit.ct", F.lit("")).alias("ct"),
        F.coalesce("hit.elapsed_ms", F.lit(0).cast("bigint")).alias("elapsed_ms"),
    )


def redirects(pages: DataFrame, url: str = "url", final_url: str = "final_url") -> DataFrame:
    """``url, final_url`` in canonical form of every page that led elsewhere, one row per requested URL.

    Of several rows for one URL the first by ``page_id`` counts; a page without ``final_url``, or with its
    own URL there, is no redirect.
    """
    pairs = pages.select(
        "page_id", canonical_url(F.col(url)).alias("url"), canonical_url(F.col(final_url)).alias("final_url")
    )
    first = pairs.groupBy("url").agg(F.min_by("final_url", "page_id").alias("final_url"))
    return first.filter("final_url != '' AND final_url != url")


def with_final_url(rows: DataFrame, redirected: DataFrame, url: str = "url") -> DataFrame:
    """``rows`` with the ``final_url`` of each URL: where its page led, else the URL itself.

    One step, as it was fetched: a redirect that leads to another requested URL is not followed on.
    """
    known = own_side(redirected.select(F.col("url").alias(url), "final_url"))
    joined = rows.drop("final_url").join(known, url, "left")
    return joined.withColumn("final_url", F.coalesce("final_url", url))
