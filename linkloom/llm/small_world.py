"""A hierarchical navigable small-world graph over the vectors of one shard, in flat arrays.

Rows are inserted and searched many at a time: all walks of a batch take their steps together, so a
step is one gather and one product. Neighbours of row ``i`` on a level are row ``i`` of an integer
matrix, -1 where there are fewer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NONE = -1


@dataclass
class Graph:
    """``vectors`` of equal length in float32, ``levels`` of neighbour matrices, an entry row.

    Rows are in order of their level, highest first, so level ``h`` holds the first
    ``len(levels[h])`` rows and row 0 is the entry.
    """

    vectors: np.ndarray
    levels: list[np.ndarray]


def levelled(n: int, degree: int, seed: int) -> np.ndarray:
    """Number of rows on each level: a geometric law with ratio ``1 / degree``."""
    draws = np.random.default_rng(seed).random(n)
    tops = np.floor(-np.log(np.maximum(draws, 1e-12)) / np.log(max(2, degree))).astype(int)
    return np.array([int((tops >= h).sum()) for h in range(tops.max(initial=0) + 1)])


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of each query with its own rows."""
    return (rows @ queries[:, :, None])[:, :, 0]


def walk(
    vectors: np.ndarray,
    links: np.ndarray,
    queries: np.ndarray,
    entries: np.ndarray,
    width: int,
    stride: int = 4,
) -> tuple[np.ndarray, np.ndarray]:
    """Best-first walks of all queries on one level: the ``width`` best rows met and their scores.

    Every step opens the ``stride`` best rows of each walk that were not opened yet; a walk ends when
    its whole list was opened.
    """
    q, n = len(queries), len(links)
    rows = np.full((q, width), NONE)
    scores = np.full((q, width), -np.inf, np.float32)
    opened = np.zeros((q, width), bool)
    met = np.zeros((q, n + 1), bool)  # the last column stands for no row
    met[:, n] = True
    start = entries.shape[1]
    rows[:, :start] = entries
    first = _products(queries, vectors[entries])
    scores[:, :start] = np.where(entries >= 0, first, -np.inf)
    np.put_along_axis(met, np.where(entries >= 0, entries, n), True, 1)
    going = np.arange(q)
    while len(going):
        best = np.where(opened[going], -np.inf, scores[going])
        at = np.argpartition(-best, min(stride, width) - 1, axis=1)[:, :stride]
        live = np.take_along_axis(best, at, 1) > -np.inf
        some = live.any(axis=1)
        going, at, live = going[some], at[some], live[some]
        if not len(going):
            break
        opened[going[:, None], at] |= live
        near = links[np.where(live, rows[going[:, None], at], 0)]
        near = np.where(live[:, :, None], near, NONE).reshape(len(going), -1)
        near = np.where(near < 0, n, near)
        near = np.where(met[going[:, None], near], n, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        met[going[:, None], near] = True
        found = _products(queries[going], vectors[np.where(near < n, near, 0)])
        found = np.where(near < n, found, -np.inf)
        all_scores = np.concatenate([scores[going], found], axis=1)
        keep = np.argpartition(-all_scores, width - 1, axis=1)[:, :width]
        scores[going] = np.take_along_axis(all_scores, keep, 1)
        rows[going] = np.take_along_axis(np.concatenate([rows[going], near], axis=1), keep, 1)
        unseen = np.concatenate([opened[going], np.zeros(near.shape, bool)], axis=1)
        opened[going] = np.take_along_axis(unseen, keep, 1)
    rows = np.where(scores > -np.inf, rows, NONE)
    order = np.argsort(-scores, axis=1, kind="stable")
    return np.take_along_axis(rows, order, 1), np.take_along_axis(scores, order, 1)


def spread(vectors: np.ndarray, rows: np.ndarray, scores: np.ndarray, degree: int) -> np.ndarray:
    """At most ``degree`` of each candidate list (best first): those nearer to their row than to any
    chosen before, then the best of the others."""
    q, c = rows.shape
    x = vectors[np.where(rows >= 0, rows, 0)]
    between = x @ x.transpose(0, 2, 1)
    chosen = np.zeros((q, c), bool)
    for i in range(c):
        shaded = (np.where(chosen[:, :i], between[:, i, :i], -np.inf) > scores[:, i, None]).any(axis=1)
        chosen[:, i] = (rows[:, i] >= 0) & ~shaded & (chosen.sum(axis=1) < degree)
    order = np.argsort(~chosen, axis=1, kind="stable")[:, :degree]
    out = np.take_along_axis(rows, order, 1)
    return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=NONE)


def _link_back(vectors: np.ndarray, links: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Adds the new rows to the lists of their neighbours; full lists are chosen anew."""
    capacity = links.shape[1]
    to, frm = chosen.ravel(), np.repeat(new, chosen.shape[1])
    to, frm = to[to >= 0], frm[to >= 0]
    order = np.argsort(to, kind="stable")
    to, frm = to[order], frm[order]
    targets, at, counts = np.unique(to, return_index=True, return_counts=True)
    old = links[targets]
    have = (old >= 0).sum(axis=1)
    wide = np.full((len(targets), capacity + int(counts.max(initial=0))), NONE)
    wide[:, :capacity] = old
    place = np.arange(len(to)) - np.repeat(at, counts) + np.repeat(have, counts)
    wide[np.repeat(np.arange(len(targets)), counts), place] = frm
    full = have + counts > capacity
    links[targets[~full]] = wide[~full][:, :capacity]
    for a in range(0, int(full.sum()), 256):
        own, lists = targets[full][a : a + 256], wide[full][a : a + 256]
        scores = _products(vectors[own], vectors[np.where(lists >= 0, lists, 0)])
        scores = np.where(lists >= 0, scores, -np.inf)
        order = np.argsort(-scores, axis=1, kind="stable")
        lists, scores = np.take_along_axis(lists, order, 1), np.take_along_axis(scores, order, 1)
        links[own] = spread(vectors, lists, scores, capacity)


def build(vectors: np.ndarray, degree: int = 24, width: int = 96, seed: int = 7) -> Graph:
    """Inserts rows in batches that grow with the graph; rows of a batch see each other as well.

    All ``vectors`` should have one length (see ``lifted``), so that the largest product is the
    nearest row.
    """
    n = len(vectors)
    sizes = levelled(n, degree, seed)
    levels = [np.full((size, degree * 2 if h == 0 else degree), NONE) for h, size in enumerate(sizes)]
    graph = Graph(vectors, levels)
    done = min(n, 1)
    while done < n:
        upto = min(n, done + min(256, max(1, done // 2)))
        new = np.arange(done, upto)
        entries = np.zeros((len(new), 1), np.int64)
        for h in range(len(levels) - 1, -1, -1):
            size = len(levels[h])
            there = min(done, size)
            if there == 0:
                continue
            coming = new[new < size]
            asked = vectors[new]
            rows, scores = walk(
                vectors, levels[h][:there], asked, entries, width if len(coming) else 1
            )
            entries = rows[:, : min(4, rows.shape[1])]
            entries = np.where(entries >= 0, entries, rows[:, :1])
            if len(coming):
                fellows = vectors[coming] @ vectors[coming].T
                np.fill_diagonal(fellows, -np.inf)
                some = np.argsort(-fellows, axis=1, kind="stable")[:, :degree]
                rows = np.concatenate([rows[: len(coming)], coming[some]], axis=1)
                near = np.take_along_axis(fellows, some, 1)
                scores = np.concatenate([scores[: len(coming)], near], axis=1)
                rows = np.where(scores > -np.inf, rows, NONE)
                order = np.argsort(-scores, axis=1, kind="stable")[:, :width]
                rows, scores = np.take_along_axis(rows, order, 1), np.take_along_axis(scores, order, 1)
                chosen = spread(vectors, rows, scores, degree)
                levels[h][coming, : chosen.shape[1]] = chosen
                _link_back(vectors, levels[h], coming, chosen)
        done = upto
    return graph


def search(graph: Graph, queries: np.ndarray, width: int, block: int = 64) -> np.ndarray:
    """Rows found nearest to each query, best first, -1 where there are fewer."""
    out = []
    for a in range(0, len(queries), block):
        asked = queries[a : a + block]
        entries = np.zeros((len(asked), 1), np.int64)
        for h in range(len(graph.levels) - 1, -1, -1):
            links = graph.levels[h]
            if len(links) == 0:
                continue
            rows, _ = walk(graph.vectors, links, asked, entries, width if h == 0 else 4)
            entries = np.where(rows[:, :4] >= 0, rows[:, :4], rows[:, :1])
        out.append(rows)
    return np.concatenate(out)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more component that gives all the longest one's length.

    Products with a query whose added component is 0 stay as they are.
    """
    norms = np.einsum("nd,nd->n", vectors, vectors)
    rest = np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))
    return np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)
