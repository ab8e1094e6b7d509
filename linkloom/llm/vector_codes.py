"""Codes for vectors: a codebook per part, trained in rounds with norm-of-sum bounds.

A vector is cut into parts and every part takes the index of its codebook's nearest entry. Entries lie in
small groups, and a part keeps, for each group, a lower bound of its distance to the group's other entries
and the round that the bound was made in. All codebooks of earlier rounds are kept as well (they are small),
so a bound is lowered by how far an entry is from where it was in that round, not by the sum of all its
steps since. Only groups whose lowered bound does not exceed the distance to the part's own entry are
scanned again, in whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import ready, table, written
from linkloom.llm.vectors import matrix
from linkloom.session import own_side

PARTS = 16
ENTRIES = 64  # of a codebook; at most 256, as a code has two digits
ROUNDS = 2
SCALE = 256.0
GROUP = 8  # entries that share a bound
ROWS = 512  # vectors compared at once
# Bounds are held in 32 bits: room for their rounding, taken off lower bounds and added to distances.
_ROOM = 1e-6

_STATE = "vec_id long, label string, x array<long>, own binary, bound binary, stamp binary"
_CODED = "vec_id long, label string, code string, error long"
History = list[np.ndarray]


def whole_numbers(column: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, held within what a squared distance in 64 bits allows."""
    x = matrix(column).astype(np.float64)
    most = math.isqrt((2**63 - 1) // x.shape[1]) // 2
    return np.clip(np.floor(x * scale), -most, most).astype(np.int64)


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of ``x(n, width)`` to ``entries(k, width)``, in whole numbers."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        step = x[:, i, None] - entries[None, :, i]
        out += step * step
    return out


def _below(squares: np.ndarray) -> np.ndarray:
    """Roots rounded down."""
    return (np.sqrt(squares.astype(np.float64)) * (1 - _ROOM)).astype(np.float32)


def drifts(history: History, part: int, starts: np.ndarray) -> np.ndarray:
    """How far the entries of each group are from where they were in every round, the farthest, rounded up."""
    now = history[-1][part].astype(np.float64)
    moved = [np.sqrt(((now - then[part]) ** 2).sum(axis=1)) * (1 + _ROOM) for then in history]
    return np.array([np.maximum.reduceat(m, starts) for m in moved])


def _bounds(found: np.ndarray, own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bounds of all groups from all distances, each part's own entry aside."""
    rest = found.astype(np.float64)
    rest[np.arange(len(rest)), own] = np.inf
    return _below(np.minimum.reduceat(rest, starts, axis=1))


def _first(x: np.ndarray, entries: np.ndarray, starts: np.ndarray):
    found = _distances(x, entries)
    own = found.argmin(axis=1)  # the first of equals
    return own, found[np.arange(len(x)), own], _bounds(found, own, starts)


def reassigned(
    x: np.ndarray, history: History, part: int, own: np.ndarray, bound: np.ndarray, stamp: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """New ``own`` and squared distances of one part of many vectors, and how many distances were counted.

    ``bound(n, groups)`` and ``stamp(n, groups)`` are brought up to date in place.
    """
    entries, now = history[-1][part], len(history) - 1
    starts = np.arange(0, len(entries), GROUP)
    step = x - entries[own]
    best = (step * step).sum(axis=1)
    to_own = np.sqrt(best.astype(np.float64)) * (1 + _ROOM)
    lowered = bound - drifts(history, part, starts)[stamp, np.arange(len(starts))]
    open_ = ~(lowered > to_own[:, None])
    new, counted = own.copy(), len(x)
    for g, start in enumerate(starts):
        rows = np.flatnonzero(open_[:, g])
        if len(rows) == 0:
            continue
        found = _distances(x[rows], entries[start : start + GROUP])
        counted += found.size
        at = found.argmin(axis=1)
        least = found[np.arange(len(rows)), at]
        nearer = (least < best[rows]) | (least == best[rows]) & (at + start < new[rows])
        new[rows[nearer]], best[rows[nearer]] = at[nearer] + start, least[nearer]
        rest = found.astype(np.float64)
        inside = np.flatnonzero((own[rows] >= start) & (own[rows] < start + GROUP))
        rest[inside, own[rows[inside]] - start] = np.inf
        bound[rows, g], stamp[rows, g] = _below(rest.min(axis=1)), now
    moved = np.flatnonzero(new != own)
    if len(moved):  # bounds leave out another entry now
        found = _distances(x[moved], entries)
        counted += found.size
        bound[moved], stamp[moved] = _bounds(found, new[moved], starts), now
    return new, best, counted


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _unpacked(column: pa.Array, kind: type, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape).copy()


def _begin(rows: DataFrame, history: History, scale: float) -> DataFrame:
    """First assignment: every part scans its whole codebook and keeps bounds of round 0."""
    parts, entries, _ = history[0].shape
    starts = np.arange(0, entries, GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                piece = batch.slice(a, ROWS)
                x = whole_numbers(piece.column("embedding"), scale)
                cut = x.reshape(len(x), parts, -1)
                own = np.zeros((len(x), parts), np.uint8)
                bound = np.zeros((len(x), parts, len(starts)), np.float32)
                for p in range(parts):
                    own[:, p], _, bound[:, p] = _first(cut[:, p], history[0][p], starts)
                yield _state(piece, x, own, bound, np.zeros(bound.shape, np.uint8))

    return rows.mapInArrow(run, _STATE)


def _state(piece: pa.RecordBatch, x, own, bound, stamp) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel())
    )
    return pa.record_batch(
        [piece.column("vec_id"), piece.column("label"), lists, *map(_packed, (own, bound, stamp))],
        names=["vec_id", "label", "x", "own", "bound", "stamp"],
    )


def _again(state: DataFrame, history: History, last: bool) -> DataFrame:
    """One more assignment; the last one gives codes and errors in place of the state."""
    parts, entries, _ = history[0].shape
    groups = -(-entries // GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                piece = batch.slice(a, ROWS)
                x = matrix(piece.column("x"))
                cut = x.reshape(len(x), parts, -1)
                own = _unpacked(piece.column("own"), np.uint8, (parts,))
                bound = _unpacked(piece.column("bound"), np.float32, (parts, groups))
                stamp = _unpacked(piece.column("stamp"), np.uint8, (parts, groups))
                error = np.zeros(len(x), np.int64)
                for p in range(parts):
                    b, s = bound[:, p].copy(), stamp[:, p].copy()
                    new, best, _ = reassigned(cut[:, p], history, p, own[:, p].astype(np.int64), b, s)
                    own[:, p], bound[:, p], stamp[:, p] = new, b, s
                    error += best
                if not last:
                    yield _state(piece, x, own, bound, stamp)
                    continue
                codes = pa.array([row.tobytes().hex() for row in own], pa.string())
                yield pa.record_batch(
                    [piece.column("vec_id"), piece.column("label"), codes, pa.array(error)],
                    names=["vec_id", "label", "code", "error"],
                )

    return state.mapInArrow(run, _CODED if last else _STATE)


def _moved(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The next codebooks: rounded-down means of the assigned parts; unused entries stay.

    Every task sums its parts, Spark sums the tasks; the driver reads one row per used entry.
    """
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), np.int64)
        n = np.zeros(parts * entries, np.int64)

        def out() -> pa.RecordBatch:
            used = np.flatnonzero(n)
            columns = [used, n[used], *sums[used].T]
            return pa.record_batch([pa.array(c) for c in columns], names=names)

        held = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix(batch.column("x")).reshape(batch.num_rows * parts, width)
            own = _unpacked(batch.column("own"), np.uint8, (parts,)).astype(np.int64)
            at = (own + np.arange(parts) * entries).ravel()
            np.add.at(sums, at, x)
            n += np.bincount(at, minlength=len(n))
            held += 1
            if held % 4096 == 0:  # long before a sum leaves 64 bits
                yield out()
                sums[:], n[:] = 0, 0
        yield out()

    names = ["entry", "n", *(f"s{i}" for i in range(width))]
    partial = state.select("x", "own").mapInArrow(run, ", ".join(f"{name} long" for name in names))
    whole = partial.groupBy("entry").agg(
        *[F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in names[1:]]
    )
    new = book.copy().reshape(parts * entries, width)
    for row in whole.collect():
        new[row.entry] = [int(row[f"s{i}"]) // int(row.n) for i in range(width)]
    return new.reshape(parts, entries, width)


def codebooks_digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def trained(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: float = SCALE,
) -> tuple[DataFrame | None, np.ndarray | None]:
    """``vec_id, label, code, error`` of every vector and the final codebooks (part, entry, position).

    Rows whose vector is null, empty or holds a null or non-finite component take no part, nor do
    vectors of another length than that of the smallest ``vec_id`` (a multiple of ``parts``). Each
    codebook starts as that part of the ``entries`` rows of smallest ids (repeated ids in the order of
    their components); with fewer rows it is smaller. A row without id is coded and counted, but begins
    no entry. Repeated rows count as often as they are there. Components scaled beyond what a squared
    distance in 64 bits allows count as the farthest allowed. Nothing at all without an id.
    """
    finite = F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), "embedding").filter(
        (F.size("embedding") > 0) & F.coalesce(finite, F.lit(False))
    )
    order = rows.filter("vec_id is not null").orderBy("vec_id", "embedding")
    leads = order.filter(F.size("embedding") % parts == 0).limit(1).collect()
    if not leads:
        return None, None
    width = len(leads[0].embedding)
    rows = rows.filter(F.size("embedding") == width)
    seeds = order.filter(F.size("embedding") == width).limit(entries).collect()
    first = whole_numbers(pa.array([row.embedding for row in seeds], pa.list_(pa.float64())), scale)
    book = np.ascontiguousarray(first.reshape(len(seeds), parts, -1).transpose(1, 0, 2))
    history = [book]
    state = written(_begin(rows, history, scale), "assigned")
    for i in range(rounds):
        history.append(_moved(state, history[-1]))
        if i + 1 < rounds:
            state = written(_again(state, history, last=False), "assigned")
    return _again(state, history, last=True), history[-1]


def vector_codes(vectors: DataFrame, **settings) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of ``vectors(vec_id, embedding, label)``.

    ``code`` has two hex digits a part, ``error`` is the squared distance to the coded vector and
    ``label_error`` the sum of errors of all rows with that label, nulls being one label (cut to 64
    bits). Rows that take part and the settings are those of ``trained``; an empty table gives no rows.
    Other columns are ignored.
    """
    coded, book = trained(vectors, **settings)
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if coded is None:
        return vectors.sparkSession.createDataFrame([], schema)
    coded = written(coded, "codes")
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long")
    sums = own_side(coded.groupBy("label").agg(total.alias("label_error")))
    named = coded.withColumn("label_", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    sums = sums.select(
        F.coalesce(F.concat(F.lit("="), "label"), F.lit("")).alias("label_"), "label_error"
    )
    return named.join(sums, "label_").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(book)).alias("codebooks_sha256")
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings."""
    return vector_codes(table(ready(spark), sf_dir, "embeddings"))


def _round(old: str, book: str, new: str) -> str:
    """SQL of an assignment and of the codebook after it."""
    return f"""
{old} AS ({_assign(book)}),
sums{new} AS (
  SELECT p, e, pos, sum(x[pos])::HUGEINT AS s, count(*) AS n
  FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS pos FROM {old}) GROUP BY ALL),
means{new} AS (
  SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS y FROM sums{new} GROUP BY p, e),
{new} AS (SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM {book} b LEFT JOIN means{new} m USING (p, e))"""


def _assign(book: str) -> str:
    return f"""
  SELECT r, vec_id, label, p, x, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (
    SELECT r, vec_id, label, a.p, x, e,
      list_sum(list_transform(list_zip(x, y), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::BIGINT AS d
    FROM pieces a JOIN {book} b ON a.p = b.p)
  GROUP BY ALL"""


SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
pieces AS (
  SELECT r, vec_id, label, p, x[p * len(x) // {PARTS} + 1 : (p + 1) * len(x) // {PARTS}] AS x
  FROM kept, unnest(range({PARTS})) AS t(p)),
book0 AS (SELECT p, r - 1 AS e, x AS y FROM pieces WHERE r <= {ENTRIES}),
{_round("at0", "book0", "book1")},
{_round("at1", "book1", "book2")},
final AS ({_assign("book2")}),
coded AS (
  SELECT r, vec_id, label, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM final GROUP BY ALL),
digest AS (
  SELECT sha256(string_agg(y[pos]::VARCHAR, ',' ORDER BY p, e, pos)) AS codebooks_sha256
  FROM (SELECT p, e, y, unnest(range(1, len(y) + 1)) AS pos FROM book2))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, digest
"""
