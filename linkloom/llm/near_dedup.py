"""Near-duplicate texts by a chosen-path set similarity join.

A text is its set of word shingles. In every tree, texts are dealt to child nodes by the minwise
values at one or two coordinates that the node chooses, 1/threshold of them on average, so a pair at
the threshold keeps one common child on average at every level. Nodes of at most ``limit`` texts are
compared exhaustively: first their sketches, then, for texts with a likely partner, the full sets.
Nodes still above ``limit`` after the last level are compared as pairs of blocks, so no pair of a
node is left out.
Independent trees are repeated until a pair at the threshold is met with chance ``RECALL`` at the depth
its texts reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.common import let_go, ready, saved, table, text_pieces, texts, written
from linkloom.llm.components import components
from linkloom.llm.nodes import bundles, star_links
from linkloom.llm.words import LOWER, mixed, shingle_sets, sketches, word_codes, word_spans

SIZE = 64  # coordinates of a sketch
TREES = 16  # at least; texts in deep nodes get as many as RECALL asks for
RECALL = 0.99  # of pairs at the threshold, at any depth
LIMIT = 1024  # texts of a node compared exhaustively
LEVELS = 24
_U = np.uint64


def _sets(data: np.ndarray, offsets: np.ndarray, width: int):
    low = LOWER[data]
    starts, ends, firsts = word_spans(low, offsets)
    return shingle_sets(word_codes(low, starts, ends), firsts, width)


def set_keys(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Two 64-bit keys of each whole set; zeros for an empty one."""
    keys = np.zeros((2, len(offsets) - 1), _U)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        keys[0, full] = np.add.reduceat(mixed(flat + _U(1)), offsets[:-1][full])
        keys[1, full] = np.bitwise_xor.reduceat(mixed(flat ^ _U(977)), offsets[:-1][full])
    return keys


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, key_a, key_b, sketch``; the keys identify the whole set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_pieces(batches):
            flat, where = _sets(data, offsets, width)
            counts = np.diff(where)
            keys = set_keys(flat, where)
            marks = sketches(flat, where, SIZE)
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    pa.array(counts),
                    pa.array(keys[0].view(np.int64)),
                    pa.array(keys[1].view(np.int64)),
                    pa.array([m.tobytes() for m in marks], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "key_a", "key_b", "sketch"],
            )

    schema = "doc_id long, n_shingles long, key_a long, key_b long, sketch binary"
    return texts(docs).mapInArrow(run, schema)


def _children(rows: DataFrame, extra: float) -> DataFrame:
    """Child nodes of ``rows(path, id, sketch)``; a node has a second branch with chance ``extra``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column("id").to_numpy()
            marks = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32)
            marks = marks.reshape(-1, SIZE)
            node = mixed(batch.column("path").to_numpy().view(_U))
            one = (node % _U(SIZE)).astype(np.int64)
            step = ((node >> _U(16)) % _U(SIZE - 1)).astype(np.int64) + 1
            two = (one + step) % SIZE
            also = np.flatnonzero(((node >> _U(32)) & _U(0xFFFF)).astype(np.float64) < extra * 65536)
            at = np.r_[np.arange(len(ids)), also]
            coordinate = np.r_[one, two[also]]
            value = marks[at, coordinate].astype(_U)
            child = mixed(node[at] ^ mixed(value * _U(SIZE) + coordinate.astype(_U)))
            yield pa.record_batch(
                [pa.array(child.view(np.int64)), pa.array(ids[at])], names=["path", "id"]
            )

    return rows.mapInArrow(run, "path long, id long")


def _met(rows: DataFrame) -> DataFrame:
    """Rows of nodes that hold at least two texts, with the node's size and membership.

    Rows are dealt by node once; they are not summed, written and joined to their sums.
    """
    node = Window.partitionBy("path")
    return rows.select(
        "path",
        "id",
        F.count("*").over(node).alias("n"),
        F.bit_xor(F.xxhash64("id")).over(node).alias("in_a"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).over(node).alias("in_b"),
    ).filter("n > 1")


def _first(small: DataFrame) -> DataFrame:
    """Rows ``path, id`` of small nodes; nodes with the same members are one, at whatever level."""
    same = Window.partitionBy("n", "in_a", "in_b")
    return small.withColumn("_first", F.min("path").over(same)).filter("path = _first").select("path", "id")


def _once(rows: DataFrame) -> DataFrame:
    """Nodes of ``rows`` with the same members are one; large ones are not held together for it."""
    once = rows.groupBy("n", "in_a", "in_b").agg(F.min("path").alias("path")).select("path")
    return rows.join(once, "path", "left_semi")


def _blocks(rows: DataFrame, limit: int) -> DataFrame:
    """Nodes above the limit dealt into blocks that all hold the node's smallest text: a first pass
    that joins near-identical sets before ``_rest`` compares what it leaves."""
    pivots = rows.groupBy("path").agg(F.min("id").alias("pivot"))
    dealt = rows.withColumn("_b", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") * 2 / limit)))
    block = F.xxhash64("path", "_b")
    members = dealt.select("path", "_b", "id").distinct()
    shared = members.select("path", "_b").distinct().join(pivots, "path")
    return (
        members.select(block.alias("path"), "id")
        .union(shared.select(block.alias("path"), F.col("pivot").alias("id")))
        .distinct()
    )


def _rest(left: DataFrame, whole: DataFrame, limit: int) -> DataFrame:
    """Pairs of half-size blocks ``path, id`` that hold every pair of ``left`` still to be compared.

    Texts of a node's largest component in ``whole(id, component)`` are linked already and not compared
    with each other; every other text of the node meets all texts of it.
    """
    half = max(1, limit // 2)
    known = left.select("path", "id").join(whole, "id", "left")
    known = saved(known.select("path", "id", F.coalesce("component", "id").alias("component")))
    sizes = known.groupBy("path", "component").agg(F.count("*").alias("n"))
    most = saved(
        sizes.groupBy("path")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"))
        .filter("n > most.n")
        .select(
            "path",
            F.col("most.component").alias("main"),
            F.ceil((F.col("n") - F.col("most.n")) / half).cast("int").alias("outer"),
            F.ceil(F.col("most.n") / half).cast("int").alias("inner"),
        )
    )
    rows = known.join(most, "path").withColumn("out", F.col("component") != F.col("main"))
    place = F.xxhash64("id")
    at = F.when(F.col("out"), F.pmod(place, "outer")).otherwise(F.col("outer") + F.pmod(place, "inner"))
    last = F.when(F.col("out"), F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1
    paired = rows.withColumn("at", at.cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), last.cast("int")))
    )
    block = F.xxhash64("path", F.least("at", "other"), F.greatest("at", "other"))
    return paired.filter("at != other").select(block.alias("path"), "id")


def recall(depth: int, trees: int, percent: int) -> float:
    """Chance that a pair with ``percent`` of its coordinates equal meets at ``depth`` in a tree."""
    p, extra, q = percent / 100, 100 / percent - 1, 1.0
    for _ in range(depth):
        q = 1 - (1 - p * q) * (1 - extra * p * q)
    return 1 - (1 - q) ** trees


def _grown(
    marks: DataFrame, extra: float, trees: range, limit: int, levels: int, enough: int
) -> tuple[list[DataFrame], DataFrame | None, DataFrame | None]:
    """Small nodes of ``trees`` by level with their membership, nodes still above the limit after the
    last level, and the ids of texts in nodes that branch on below level ``enough``.

    A child's path says where it comes from, so no text is twice in a node.
    """
    roots = F.explode(F.array(*[F.xxhash64(F.lit(t)) for t in trees]))
    rows = _children(marks.select(roots.alias("path"), "id", "sketch"), extra)
    found, deep = [], None
    for level in range(levels):
        met = saved(_met(rows))
        found.append(met.filter(F.col("n") <= limit))
        let_go(marks.sparkSession)
        large = met.filter(F.col("n") > limit)
        if not large.take(1):
            return found, None, deep
        if level + 1 == enough:
            deep = saved(large.select("id").distinct())
        if level + 1 < levels:
            rows = _children(
                large.select("path", "id").join(marks, "id").select("path", "id", "sketch"), extra
            )
    return found, large, deep


def nodes(
    marks: DataFrame, percent: int, trees: int, limit: int, levels: int
) -> tuple[list[DataFrame], DataFrame | None]:
    """Small nodes ``path, id`` of all trees over ``marks(id, sketch)``, in one table, and the nodes
    still above the limit after the last level.

    The driver reads one flag per level: whether a node above the limit is left. A node with the
    same members as another is compared once. Recall falls with depth: texts that go deeper than
    ``trees`` trees are enough for get further trees of their own, as many as the last level asks for.
    A pair with one text that does not go so deep ends above that depth in every tree.
    """
    extra = 100 / percent - 1
    enough = 1
    while enough < levels and recall(enough + 1, trees, percent) >= RECALL:
        enough += 1
    found, left, deep = _grown(marks, extra, range(trees), limit, levels, enough)
    wanted = trees
    while recall(levels, wanted, percent) < RECALL:
        wanted += 1
    if deep is not None and wanted > trees:
        own = saved(marks.join(deep, "id", "left_semi"))
        more, last, _ = _grown(own, extra, range(trees, wanted), limit, levels, enough)
        found = [*found, *more]
        if left is not None and last is not None:
            left = left.union(last)
        left = left if left is not None else last
    return [_first(reduce(DataFrame.union, found))], left


def _likely(found: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Rows of ``found(path, id)`` whose sketch agrees with another of the node almost as asked."""
    # Four standard deviations of an estimate from SIZE coordinates.
    p = percent / 100
    least = int(SIZE * (p - 4 * (p * (1 - p) / SIZE) ** 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, cuts in bundles(batches, "path"):
            flat = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint32)
            flat = flat.reshape(-1, SIZE)
            keep = np.zeros(len(flat), bool)
            for a, b in zip(cuts[:-1], cuts[1:]):
                m = flat[a:b]
                for i in range(a, b, 64):
                    agree = (flat[i : min(b, i + 64), None, :] == m[None, :, :]).sum(axis=2)
                    agree[np.arange(len(agree)), np.arange(i - a, i - a + len(agree))] = 0
                    keep[i : i + len(agree)] = (agree >= least).any(axis=1)
            for batch in part.select(["path", "id"]).filter(pa.array(keep)).to_batches():
                yield batch

    joined = found.join(marks, "id").select("path", "id", "sketch")
    dealt = joined.repartition("path").sortWithinPartitions("path")
    return dealt.mapInArrow(run, "path long, id long")


def _confirmed(likely: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` on full sets inside each node of ``likely(path, id)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, cuts in bundles(batches, "path"):
            part = part.combine_chunks()
            pieces = text_pieces(iter(part.to_batches()))
            flats, wheres, base = [], [np.zeros(1, np.int64)], 0
            for _, data, offsets in pieces:
                flat, where = _sets(data, offsets, width)
                flats.append(flat)
                wheres.append(where[1:] + base)
                base += len(flat)
            flat, where = np.concatenate(flats), np.concatenate(wheres)
            ids = part.column("id").to_numpy()
            found = [
                star_links(ids[a:b], flat[where[a] : where[b]], where[a : b + 1] - where[a], percent)
                for a, b in zip(cuts[:-1], cuts[1:])
                if b - a > 1
            ]
            if found:
                yield pa.record_batch(
                    [pa.array(np.concatenate(c)) for c in zip(*found)], names=["a", "b"]
                )

    bodies = texts(docs).withColumnRenamed("doc_id", "id")
    joined = likely.join(bodies, "id").select("path", "id", "text")
    dealt = joined.repartition("path").sortWithinPartitions("path")
    return dealt.mapInArrow(run, "a long, b long")


def _links(
    found: list[DataFrame], marks: DataFrame, docs: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links ``a, b`` inside the nodes of all of ``found(path, id)``."""
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    likely = saved(_likely(every, marks, percent))
    let_go(docs.sparkSession)
    links = saved(_confirmed(likely, docs, width, percent))
    let_go(docs.sparkSession)
    return links


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    trees: int = TREES,
    limit: int = LIMIT,
    levels: int = LEVELS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs(doc_id, text)``.

    Two texts are linked when their sets of ``width``-word shingles have a Jaccard similarity of
    ``percent``/100 or more; a component is named by its smallest ``doc_id``, the one kept. Texts with
    one set are one text to the join, however many there are. A null or empty text, or one of blanks
    only, has no set and stands alone. A row without ``doc_id`` stands alone too, with a null
    component, and is kept. Repeated ids are one document for linking and give one row each; other
    columns are ignored. An empty table gives no rows.
    """
    known = written(signatures(docs, width), "signatures")
    key = ["n_shingles", "key_a", "key_b"]
    with_set = known.filter("n_shingles > 0 and doc_id is not null")
    first = saved(with_set.groupBy(*key).agg(F.min("doc_id").alias("id")))
    marks = saved(
        known.select(F.col("doc_id").alias("id"), "sketch")
        .join(first.select("id"), "id")
        .dropDuplicates(["id"])
    )
    let_go(docs.sparkSession)
    found, left = nodes(marks, percent, trees, limit, levels)
    if left is not None:
        left = saved(_once(left).select("path", "id", "n"))
        found = [*found, _blocks(left, limit)]
    links = _links(found, marks, docs, width, percent)
    if left is not None:
        rest = _rest(left, components(links), limit)
        links = links.union(_links([rest], marks, docs, width, percent))
    # Each repeated id with more than one text links these texts.
    same = with_set.select("doc_id", *key).distinct().join(first, key).filter("doc_id != id")
    whole = components(links.union(same.select(F.col("doc_id").alias("a"), F.col("id").alias("b"))))
    own = known.drop("sketch").join(
        whole.withColumnRenamed("id", "doc_id"), "doc_id", "left"
    )
    component = F.coalesce("component", "doc_id")
    return own.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by their four-word shingles."""
    return near_duplicates(table(ready(spark), sf_dir, "documents"), width=4)
