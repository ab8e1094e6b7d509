"""Approximate nearest neighbours: one small-world graph per shard, shard results merged."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import ready, table, written
from linkloom.llm.nodes import groups
from linkloom.llm.small_world import Graph, build, lifted, search
from linkloom.llm.vectors import answered, in_order, matrix, merged, sent, shard_of, usable

SHARD_ROWS = 8192
DEGREE = 24
BUILD_WIDTH = 64
SEARCH_WIDTH = 128
_INDEX = "shard int, width int, ids binary, firsts binary, vectors binary, sizes binary, links binary"
_FOUND = "query_id long, shard int, vec_id long, score double"


def build_index(
    vectors: DataFrame,
    shard_rows: int = SHARD_ROWS,
    degree: int = DEGREE,
    width: int = BUILD_WIDTH,
) -> tuple[DataFrame, int]:
    """One row per shard (and length of vectors) with its graph as flat arrays; the number of shards.

    Every usable row is indexed. Equal vectors are one row of the graph with a list of ids, so copies
    of one vector do not fill each other's neighbour lists.
    """
    rows = usable(vectors, zero=False).withColumn("width", F.size("embedding"))
    shards = max(1, -(-rows.count() // shard_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "place"):
            yield _index_row(group.combine_chunks(), degree, width)

    key = ("shard", "width")
    placed = rows.withColumn("shard", shard_of(shards)).withColumn("place", F.xxhash64(*key))
    dealt = placed.repartition(shards, *key).sortWithinPartitions("place", *key)
    return dealt.mapInArrow(run, _INDEX), shards


def _index_row(group: pa.Table, degree: int, width: int) -> pa.RecordBatch:
    ids = group.column("vec_id").to_numpy()
    x = matrix(group.column("embedding").chunk(0))
    order = in_order(ids, x)
    ids, x = ids[order], x[order]
    unique, which = np.unique(x, axis=0, return_inverse=True)
    shuffled = np.random.default_rng(3).permutation(len(unique))
    which = np.argsort(shuffled)[which.ravel()]
    by_vector = np.argsort(which, kind="stable")
    firsts = np.searchsorted(which[by_vector], np.arange(len(unique) + 1))
    graph = build(lifted(unique[shuffled]), degree, width)
    flat = [links.astype(np.int32).ravel() for links in graph.levels]
    values = [
        group.column("shard")[0].as_py(),
        group.column("width")[0].as_py(),
        ids[by_vector].tobytes(),
        firsts.astype(np.int64).tobytes(),
        unique[shuffled].tobytes(),
        np.array([links.shape for links in graph.levels], np.int64).tobytes(),
        np.concatenate(flat).tobytes(),
    ]
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    names = [c.split()[0] for c in _INDEX.split(", ")]
    return pa.record_batch([pa.array([v], t) for v, t in zip(values, types)], names=names)


def _load(parts: list[pa.RecordBatch]):
    row = parts[0].slice(0, 1).to_pylist()[0]
    x = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["width"])
    links, levels, at = np.frombuffer(row["links"], np.int32), [], 0
    for size, degree in np.frombuffer(row["sizes"], np.int64).reshape(-1, 2):
        levels.append(links[at : at + size * degree].reshape(size, degree).astype(np.int64))
        at += size * degree
    ids, firsts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["firsts"], np.int64)
    return row["shard"], ids, firsts, x, Graph(lifted(x), levels)


def _answer(k: int, width: int, held, asked: pa.RecordBatch) -> pa.RecordBatch | None:
    shard, ids, firsts, x, graph = held
    names = asked.column("vec_id").to_numpy()
    q = matrix(asked.column("embedding"))
    flat = np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)
    out: list[tuple] = []
    for name, vector, rows in zip(names, q, search(graph, flat, max(width, k + 1))):
        rows = rows[rows >= 0]
        # Each vector's smallest ids are enough: k, and one more that may be the query's own.
        lists = [ids[firsts[r] : min(firsts[r + 1], firsts[r] + k + 1)] for r in rows]
        found = np.concatenate(lists)
        scores = np.repeat(np.einsum("nd,d->n", x[rows], vector), [len(i) for i in lists])
        found, scores = found[found != name], scores[found != name]
        for j in np.lexsort((found, -scores))[:k]:
            out.append((name, shard, found[j], scores[j]))
    if not out:
        return None
    types = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    return pa.record_batch(
        [pa.array(c, t) for c, t in zip(zip(*out), types)],
        names=["query_id", "shard", "vec_id", "score"],
    )


def nearest(
    index: DataFrame, shards: int, queries: DataFrame, k: int, width: int = SEARCH_WIDTH
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``queries(vec_id, embedding)`` over an index.

    Scores are inner products in double precision, largest first, ties to the smaller id.
    """
    asked = usable(queries, zero=False).withColumn("width", F.size("embedding"))
    blank = [F.lit(None).cast("binary").alias(c) for c in ("ids", "firsts", "vectors", "sizes", "links")]
    asked = sent(asked, shards).select(
        "shard", "width", *blank, "vec_id", "embedding", F.lit(True).alias("is_query")
    )
    held = index.select(
        "*",
        F.lit(None).cast("long").alias("vec_id"),
        F.lit(None).cast("array<double>").alias("embedding"),
        F.lit(False).alias("is_query"),
    )
    key = ("shard", "width")
    stream = held.unionByName(asked).repartition(shards, *key)
    stream = stream.sortWithinPartitions(*key, "is_query", "vec_id", "embedding")
    lists = stream.mapInArrow(lambda it: answered(it, key, _load, partial(_answer, k, width)), _FOUND)
    return merged(lists.distinct(), shards, k)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The ``k`` nearest rows found for every row of ``vectors(vec_id, embedding)`` that is a query.

    Candidates are all rows but those of the query's id. Rows with a null id, a null or empty vector,
    a vector of zeros, or a component that is null or not finite take no part. An id that is repeated
    counts once, by its first vector in the order of components. Only vectors of one length are
    compared. Other columns are ignored; an empty table gives no rows.
    """
    index, shards = build_index(vectors)
    return nearest(written(index, "graphs"), shards, vectors.filter(is_query), k)


def op9_small_world_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest of every twentieth vector."""
    vectors = table(ready(spark), sf_dir, "embeddings")
    return nearest_neighbours(vectors, F.col("vec_id") % 20 == 0, k=20)
