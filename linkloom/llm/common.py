"""Session settings, tables and Arrow helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import gc
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import cut, fresh_path, tune

# Rows of one Arrow batch: bounds what a Python worker holds at once beside its own arrays.
BATCH_ROWS = 1000
# Text bytes worked on at once inside a batch. A longer text is one piece of its own.
PIECE_BYTES = 2 << 20


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators count on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, ``keep`` and ``text`` only, null texts as empty ones."""
    return docs.select(*(keep or ("doc_id",)), F.coalesce("text", F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder: survives executors, and its columns can be pruned."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(df: DataFrame) -> DataFrame:
    """``df`` materialised in the shared folder with its lineage cut."""
    return cut(df)


def let_go(spark: SparkSession) -> None:
    """Ask the driver to collect what it no longer refers to: Spark then deletes the shuffle files of
    finished steps, which otherwise stay on the executors until the driver happens to collect.

    The listeners of a finished job hold its plan for a moment, so it waits for them, not for long.
    """
    with contextlib.suppress(Py4JJavaError):
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(5000)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the UTF-8 bytes of ``column`` and their row offsets.

    No Python string is made. A slice has at most ``most`` bytes unless it is one row.
    """
    for batch in batches:
        ends = np.cumsum(_lengths(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
            part = batch.slice(at, upto - at)
            yield part, *_flat(part.column(column))
            at = upto


def _lengths(strings: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(strings), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _flat(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if strings.null_count:
        strings = strings.fill_null("")
    wide = pa.types.is_large_string(strings.type)
    _, where, data = strings.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)
    offsets = offsets[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    if data is None or size == 0:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8, size, int(offsets[0])), offsets - offsets[0]


def worker_cache() -> dict:
    """What this Python worker keeps from task to task; shipped functions come with fresh globals."""
    place = sys.modules.setdefault("_linkloom_worker", types.ModuleType("_linkloom_worker"))
    return place.__dict__
