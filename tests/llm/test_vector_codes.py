"""Vector codes against plain rounds, and what the bounds save."""

import hashlib
import math

import numpy as np
import pytest

from linkloom.llm import vector_codes as codes
from linkloom.llm.common import ready

ROWS = "vec_id long, embedding array<float>, label int, code string, x int, own string"


def coded(rows, parts=16, entries=64, rounds=2, scale=256.0):
    """The contract with full scans; ``rows`` as they are given, repeated ids in the order of components."""
    kept = [
        (i, [math.floor(scale * v) for v in e], label)
        for i, e, label in rows
        if e and all(v is not None and math.isfinite(v) for v in e)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[r[1][p * width : (p + 1) * width] for p in range(parts)] for r in kept]
    seeds = [c for r, c in zip(kept, cut) if r[0] is not None][:entries]
    book = [[s[p] for s in seeds] for p in range(parts)]

    def near(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book[p]))

    for _ in range(rounds):
        own = [[near(c[p], p)[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(book[p])):
                mine = [c[p] for c, o in zip(cut, own) if o[p] == e]
                if mine:
                    book[p][e] = [sum(v) // len(mine) for v in zip(*mine)]
    out = []
    for (i, _, label), c in zip(kept, cut):
        found = [near(c[p], p) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    of = {}
    for _, label, _, error in out:
        of[label] = of.get(label, 0) + error
    text = ",".join(str(v) for p in book for e in p for v in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted((str(i), code, error, of[label], digest) for i, label, code, error in out)


def some_rows(n=300, d=32, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)).astype(np.float32)
    x[20:60] = x[20]  # copies, so ties
    x[100:200, : d // 2] = np.round(x[100:200, : d // 2])
    rows = [(i, [float(v) for v in row], int(i % 5) if i % 7 else None) for i, row in enumerate(x)]
    bad = [None, [], [float("nan")] * d, [float("-inf")] * d, [None, *[0.5] * (d - 1)]]
    rows += [(1000 + i, v, 1) for i, v in enumerate(bad)]
    return [*rows, (None, [0.25] * d, 2), rows[150], rows[0]]


def frame(spark, rows):
    return ready(spark).createDataFrame([(*r, "c", 1, "o") for r in rows], ROWS)


@pytest.mark.parametrize("entries, rounds", [(64, 2), (20, 3), (64, 0), (5, 1)])
def test_codes(spark, entries, rounds):
    rows = some_rows(seed=entries)
    out = codes.vector_codes(frame(spark, rows), entries=entries, rounds=rounds).collect()
    assert out[0].__fields__ == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in out) == coded(rows, entries=entries, rounds=rounds)


def test_few_rows_other_lengths_and_none(spark):
    few = [(3, [0.5, -0.25], 1), (3, [0.5, -0.25], None), (9, [1.0, 2.0], None)]
    out = codes.vector_codes(frame(spark, [*few, (10, [1.0] * 4, 1), (11, [1.0], 1)]), parts=2).collect()
    assert sorted((str(r[0]), *r[1:]) for r in out) == coded(few, parts=2)
    assert codes.vector_codes(frame(spark, [])).collect() == []
    assert codes.vector_codes(frame(spark, [(None, [1.0] * 16, 1)])).collect() == []


def test_large_components(spark):
    rows = [(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [0.0] * 16, 2)]
    out = codes.vector_codes(frame(spark, rows), entries=1, rounds=0).collect()
    assert all(0 <= r.error < 2**63 and 0 <= r.label_error < 2**63 for r in out)


def test_net_displacement_scans_less_and_equals_full_scans():
    """Bounds of any earlier round hold, and few groups are opened once entries have settled."""
    r = np.random.default_rng(5)
    centres = r.integers(-4000, 4000, (64, 4))
    x = centres[r.integers(0, 64, 3000)] + r.integers(-60, 60, (3000, 4))
    book = x[:64].copy()
    starts = np.arange(0, 64, codes.GROUP)
    history = [book[None]]
    own, _, bound = codes._first(x, book, starts)
    stamp = np.zeros(bound.shape, np.uint8)
    counted = []
    for _ in range(6):
        new = history[-1][0].copy()
        for e in range(64):
            if (own == e).any():
                new[e] = x[own == e].sum(axis=0) // (own == e).sum()
        history.append(new[None])
        own, best, n = codes.reassigned(x, history, 0, own, bound, stamp)
        found = codes._distances(x, new)
        assert (own == found.argmin(axis=1)).all() and (best == found.min(axis=1)).all()
        counted.append(n / found.size)
    assert counted[-1] < 0.2 and counted[-1] < counted[0]
    # The net way of an entry is never longer than the sum of its steps.
    net = codes.drifts(history, 0, starts)[0]
    steps = sum(codes.drifts(history[i : i + 2], 0, starts)[0] for i in range(6))
    assert (net <= steps + 1e-9).all() and (net < 0.99 * steps).any()
