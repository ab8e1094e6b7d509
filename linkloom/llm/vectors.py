"""Vectors in shards, queries sent to every shard, and merged lists of the best."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Shards whose lists meet in one step of a merge.
FAN_IN = 8


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """``vec_id, embedding`` as doubles, without nulls, components that are null or not finite and,
    unless ``zero``, vectors of zeros."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select("vec_id", x.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.coalesce(whole, F.lit(False))
    )
    return rows if zero else rows.filter(F.exists("embedding", lambda v: v != 0))


def shard_of(shards: int) -> Column:
    """Equal ids meet in one shard."""
    return F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")


def sent(queries: DataFrame, shards: int) -> DataFrame:
    """A copy of each query for each shard."""
    return queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    width = len(column[0])
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def same_widths(batch: pa.RecordBatch, column: str = "embedding") -> Iterator[tuple[int, pa.RecordBatch]]:
    """Parts of a batch whose lists have one length."""
    import pyarrow.compute as pc

    sizes = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for width in np.unique(sizes):
        yield int(width), batch.filter(pa.array(sizes == width))


def in_order(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Rows by id, one for each: the first in the order of components where an id is repeated."""
    order = np.lexsort((*vectors.T[::-1], ids))
    return order[np.r_[True, np.diff(ids[order]) != 0]] if len(order) else order


def best_of(scores: np.ndarray, k: int) -> list[np.ndarray]:
    """Columns of the ``k`` best of each row, best first; of equals the first columns."""
    k = min(k, scores.shape[1])
    if k == 0:
        return [np.zeros(0, np.int64)] * len(scores)
    least = np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    out = []
    for row, mask in zip(scores, -scores <= least):
        at = np.flatnonzero(mask)
        out.append(at[np.argsort(-row[at], kind="stable")[:k]])
    return out


def merged(lists: DataFrame, shards: int, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``query_id, shard, vec_id, score``: a tree of merges.

    Every step keeps ``k`` rows of a query and a group of shards, and cuts before it shuffles.
    """
    order = (F.desc("score"), F.asc("vec_id"))
    while shards > 1:
        shards = -(-shards // FAN_IN)
        group = Window.partitionBy("query_id", "shard").orderBy(*order)
        lists = (
            lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int"))
            .withColumn("rank", F.row_number().over(group))
            .filter(F.col("rank") <= k)
            .drop("rank")
        )
    final = Window.partitionBy("query_id").orderBy(*order)
    ranked = lists.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


Batches = Iterator[pa.RecordBatch]


def answered(
    stream: Batches,
    key: tuple[str, ...],
    load: Callable[[list[pa.RecordBatch]], object],
    answer: Callable[[object, pa.RecordBatch], pa.RecordBatch | None],
) -> Batches:
    """Runs ``answer`` on the queries of each shard; rows with ``is_query`` false come first."""
    held: list[pa.RecordBatch] = []
    last, shard = None, None
    for batch in stream:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        asks = batch.column("is_query").to_numpy(zero_copy_only=False)
        marks = list(zip(*columns, asks))
        a = 0
        while a < len(marks):
            b = a + 1
            while b < len(marks) and marks[b] == marks[a]:
                b += 1
            part, at, ask = batch.slice(a, b - a), marks[a][:-1], marks[a][-1]
            if at != last:
                held, last, shard = [], at, None
            if not ask:
                held.append(part)
            elif held:
                if shard is None:
                    shard = load(held)
                found = answer(shard, part)
                if found is not None:
                    yield found
            a = b
