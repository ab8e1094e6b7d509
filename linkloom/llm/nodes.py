"""Groups of candidate rows compared inside tasks: streams of sorted rows cut at their key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from linkloom.llm.words import overlaps


def groups(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` of a stream sorted by it; only the run at hand is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        new = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
        cuts = np.r_[0, np.flatnonzero(new) + 1, batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            here = tuple(v[a] for v in values)
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = here
    if held:
        yield pa.Table.from_batches(held)


def bundles(
    batches: Iterator[pa.RecordBatch], key: str, rows: int = 512
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Several whole runs at a time, with the places where they begin and end."""

    def cut(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        values = np.concatenate([b.column(key).to_numpy(zero_copy_only=False) for b in held])
        return pa.Table.from_batches(held), np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)]

    held: list[pa.RecordBatch] = []
    n, first = 0, None
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n if n < rows else rows)
            batch = batch.slice(part.num_rows)
            first = part.column(key)[0] if not held else first
            held.append(part)
            n += part.num_rows
            # The last run may go on; as long as it is the only one there is nothing to give.
            if n < rows or first == part.column(key)[-1]:
                continue
            table, cuts = cut(held)
            yield table.slice(0, cuts[-2]), cuts[:-1]
            held = table.slice(cuts[-2]).to_batches()
            n, first = table.num_rows - cuts[-2], part.column(key)[-1]
    if held:
        yield cut(held)


def clusters(joined: np.ndarray) -> np.ndarray:
    """The smallest row of each row's connected component in a symmetric 0/1 matrix, or in each of a stack."""
    n = joined.shape[-1]
    label = np.broadcast_to(np.arange(n), joined.shape[:-1])
    while True:
        least = np.where(joined, label[..., None, :], n).min(axis=-1)
        least = np.minimum(least, label)
        least = np.take_along_axis(least, least, -1)
        if np.array_equal(least, label):
            return least
        label = least


def alike(flat: np.ndarray, offsets: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets have ``100 * intersection >= percent * union``; never with an empty set."""
    sizes = np.diff(offsets)
    common = overlaps(flat, offsets)
    union = sizes[:, None] + sizes[None, :] - common
    return (100 * common >= percent * union) & (common > 0)


def pair_alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """``alike`` of two sorted sets."""
    if len(x) == 0 or len(y) == 0 or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = int(np.isin(x, y, assume_unique=True).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def star_links(
    ids: np.ndarray, flat: np.ndarray, offsets: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each connected component of alike sets: every row to its smallest."""
    if len(ids) == 2:
        same = pair_alike(flat[: offsets[1]], flat[offsets[1] :], percent)
        at = np.array([1] if same else [], np.int64)
        return ids[at], ids[at - 1]
    label = clusters(alike(flat, offsets, percent))
    at = np.flatnonzero(label != np.arange(len(ids)))
    return ids[at], ids[label[at]]
