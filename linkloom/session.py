"""Session settings and lineage cuts shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans in this package count on: hot join keys are split at run time, and a side is
# broadcast only when its measured size is under the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Streaming state on disk: visited URLs and domains outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session; cluster sizing stays with the caller."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may fall back to a temporary
    folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="linkloom-")
    sc.setCheckpointDir(made)
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and drop its lineage; hash partitioning and order are kept."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def own_side(lookup: DataFrame) -> DataFrame:
    """Materialise a table of one row per key before it is joined to many rows per key.

    Adaptive execution splits the partition of a hot key only if both sides of the join come
    straight from a shuffle of their own. An aggregate would share its shuffle with the join.
    """
    return cut(lookup)


def store(df: DataFrame, *keys: str) -> DataFrame:
    """Write ``df`` once as a table bucketed by ``keys`` in the shared folder and read it back.

    Later joins and group-bys on exactly ``keys`` use it without shuffling it again. The catalog
    entry is dropped at once (the files stay), so nothing is left behind in a shared metastore.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"linkloom_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *keys)
        .write.format("parquet")
        .option("path", fresh_path(spark, "stored"))
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


# From this many rows on, bucketing a result pays for writing it twice.
STORE_ROWS = 1_000_000


def settle(df: DataFrame, *keys: str) -> tuple[DataFrame, int]:
    """Materialise ``df`` and count it; a large result is bucketed by ``keys`` as well."""
    kept = cut(df)
    n = kept.count()
    return (store(kept, *keys) if n >= STORE_ROWS else kept), n
