"""What op5 sends for the exact comparison of lines, and the steps it compares them in."""

import random

import numpy as np
import pyarrow as pa
import pytest

from linkloom.llm import line_dedup as D
from linkloom.llm.common import ready
from linkloom.llm.nodes import bundles, clusters


def _files(manager):
    files = manager.getAllFiles()
    return [files.apply(i) for i in range(files.size())]


@pytest.fixture
def dealt(spark, monkeypatch):
    """Bytes of shuffle files at the end of each large step, before they are let go."""
    seen, let_go = [], D.let_go

    def watched(session):
        manager = session.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
        seen.append(sum(f.length() for f in _files(manager)))
        let_go(session)

    let_go(spark)
    monkeypatch.setattr(D, "let_go", watched)
    # As with tables too large to be broadcast.
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield seen
    spark.conf.set(key, before)


def test_texts_are_dealt_smaller_than_they_are(spark, dealt):
    """Nearly all of the text is in documents with a line to compare, but little of it is in such lines."""
    r = random.Random(5)
    words = lambda n: " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n))
    docs = []
    for i in range(600):
        line = words(12)
        docs += [(2 * i, f"{line}x\n{words(400)}"), (2 * i + 1, f"{words(400)}\n{line}y")]
    out = D.repeated_lines(ready(spark).createDataFrame(docs, "doc_id long, text string")).collect()
    assert {tuple(row)[:4] for row in out} == {(2 * i + 1, 1, 2 * i, 0) for i in range(600)}
    assert dealt[3] < 0.95 * sum(len(text) for _, text in docs)


def test_equal_rows_and_lines_asked_twice(spark, monkeypatch):
    """Packs of a few bytes; a line on two paths comes twice, one of equal rows once, bare lines as they are."""
    monkeypatch.setattr(D, "PACK", 20)
    docs = [(1, "añb\n\nlast"), (1, "añb\n\nlast"), (1, "other"), (2, "x\ny"), (3, None), (4, "not asked")]
    rows = ready(spark).createDataFrame(docs, "doc_id long, text string")
    known = {(r.doc_id, r.text): r.row for r in D._rows(rows).collect()}
    asked = [
        (7, 1, 1, "añb\n\nlast", 0), (8, 1, 1, "añb\n\nlast", 0), (7, 2, 1, "añb\n\nlast", 1),
        (7, 3, 1, "other", 0), (9, 4, 2, "x\ny", 1), (9, 5, 3, "", 0),
    ]
    wanted = [(path, lid, doc, known[doc, text], n) for path, lid, doc, text, n in asked]
    got = D._line_texts(spark.createDataFrame(wanted, "path long, lid long, doc_id long, row long, line_no int"), rows)
    assert sorted(map(tuple, got.collect())) == sorted(
        (path, lid, text.split("\n")[n]) for path, lid, _, text, n in asked
    )


def test_bundles_hold_whole_runs():
    keys = np.repeat(np.arange(60), np.random.default_rng(1).integers(1, 40, 60))
    for size in (7, 100, len(keys)):
        batches = [pa.record_batch([pa.array(keys[i : i + size])], names=["k"]) for i in range(0, len(keys), size)]
        parts = list(bundles(iter([batches[0].slice(0, 0), *batches]), "k", 16))
        found = [t.column("k").to_numpy() for t, _ in parts]
        assert np.array_equal(np.concatenate(found), keys)
        assert all(len(t) < 16 + 40 for t in found)
        for (_, cuts), t in zip(parts, found):
            assert np.array_equal(cuts, np.r_[0, np.flatnonzero(np.diff(t)) + 1, len(t)])
        assert len({k for t in found for k in set(t)}) == sum(len(set(t)) for t in found)


def test_sketches_and_sets_compared_at_once():
    rng = np.random.default_rng(2)
    few = rng.integers(0, 4, (6, 9, 20)).astype(np.uint8)
    nibbles = np.concatenate([few & 15, few >> 4], axis=2)
    packed = np.pad(few, ((0, 0), (0, 0), (0, 4))).view(np.uint64)
    equal = (nibbles[:, :, None] == nibbles[:, None]).sum(axis=3)
    for least in (20, 25, 30):
        near = D._near(packed, packed, 40 - least)
        assert np.array_equal(near, equal >= least)
        assert np.array_equal(clusters(near), [clusters(m) for m in near])
    owner = np.sort(rng.integers(0, 50, 3000))
    for top in (2**63, 9):  # values that differ in their last bits only are in order too
        flat = rng.integers(0, top, 3000).astype(np.uint64)
        order = D._ordered(owner, flat)
        expected = np.lexsort((flat, owner))
        assert np.array_equal(flat[order], flat[expected]) and np.array_equal(owner[order], owner[expected])
