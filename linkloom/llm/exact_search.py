"""Exact top-k search: tiled products of query blocks and shards, merged as a tree.

Components are whole numbers, so every score is exact and independent of the order of summation.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import ready, table
from linkloom.llm.vectors import answered, best_of, in_order, matrix, merged, sent, shard_of, usable

SHARD_ROWS = 16384
TILE_ROWS = 256
_MOST = 2**63 - 1
_FOUND = "query_id long, shard int, vec_id long, score long"


def _scores(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products; held in doubles where they cannot exceed 2**53, else as Python numbers."""
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * shard.shape[1]
    if bound < 2**53:
        return queries @ shard.T
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(queries) @ whole(shard).T, -_MOST, _MOST)


def _load(scale: float, parts: list[pa.RecordBatch]) -> tuple[int, np.ndarray, np.ndarray]:
    block = pa.Table.from_batches(parts).combine_chunks()
    ids = block.column("vec_id").to_numpy()
    x = np.floor(scale * matrix(block.column("embedding").chunk(0)))
    order = in_order(ids, x)
    return block.column("shard")[0].as_py(), ids[order], x[order]


def _answer(scale: float, k: int, held, asked: pa.RecordBatch) -> pa.RecordBatch | None:
    shard, ids, x = held
    names = asked.column("vec_id").to_numpy()
    q = np.floor(scale * matrix(asked.column("embedding")))
    out: list[tuple] = []
    for a in range(0, len(q), TILE_ROWS):
        tile = _scores(q[a : a + TILE_ROWS], x)
        mine = names[a : a + TILE_ROWS]
        own = np.searchsorted(ids, mine)
        # One more than asked for, as the query's own row is among them at most once.
        for name, at, row, best in zip(mine, own, tile, best_of(tile, k + 1)):
            if at < len(ids) and ids[at] == name:
                best = best[best != at]
            out += ((name, shard, ids[j], int(row[j])) for j in best[:k])
    if not out:
        return None
    return pa.record_batch(
        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
        names=["query_id", "shard", "vec_id", "score"],
    )


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int, scale: float, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of every query.

    ``vectors`` is ``vec_id, embedding``; a component x counts as floor(scale * x). Candidates are all
    rows but those of the query's id; ties go to the smaller id. Rows with a null id, a null or empty
    vector, or a component that is null or not finite take no part. An id that is repeated counts once,
    by its first vector in the order of components. Only vectors of one length are compared. Scores
    beyond 64 bits are cut to the nearest. Other columns are ignored; an empty table gives no rows.
    """
    rows = usable(vectors, zero=True).withColumn("width", F.size("embedding"))
    shards = max(1, -(-rows.count() // shard_rows))
    asked = sent(rows.filter(is_query), shards).withColumn("is_query", F.lit(True))
    kept = rows.withColumn("shard", shard_of(shards)).withColumn("is_query", F.lit(False))
    key = ("shard", "width")
    order = (*key, "is_query", "vec_id", "embedding")
    stream = kept.unionByName(asked).repartition(shards, *key).sortWithinPartitions(*order)
    load, answer = partial(_load, scale), partial(_answer, scale, k)
    lists = stream.mapInArrow(lambda it: answered(it, key, load, answer), _FOUND)
    # A repeated query has asked more than once.
    return merged(lists.distinct(), shards, k)


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best of every hundredth vector."""
    vectors = table(ready(spark), sf_dir, "embeddings")
    return exact_top_k(vectors, F.col("vec_id") % 100 == 0, k=10, scale=1024.0)
