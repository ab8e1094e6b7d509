"""Finished steps leave no shuffle files behind for the steps after them."""

import numpy as np

from linkloom.llm import near_dedup as ND
from linkloom.llm.common import let_go, ready


def _shuffles(spark):
    return spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().size()


def test_near_duplicates_let_finished_shuffles_go(spark, monkeypatch):
    ready(spark)
    seen = []

    def watched(session):
        before = _shuffles(session)
        let_go(session)
        seen.append((before, _shuffles(session)))

    monkeypatch.setattr(ND, "let_go", watched, raising=False)
    words = [" ".join(f"w{i}x{k}" for k in range(12)) for i in range(6)]
    docs = [(i * 10 + j, words[i] + " " + "tail" * (j == 2)) for i in range(6) for j in range(3)]
    got = ND.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=4, limit=4)
    assert {r.doc_id: r.component_id for r in got.collect()} == {d: d // 10 * 10 for d, _ in docs}
    # After the marks, after each level of the trees, and after both steps of the links.
    assert len(seen) >= 4


def test_rows_of_a_level_are_dealt_by_node_once(spark):
    """Each deal costs a stage of as many tasks as the session has shuffle partitions, at every level."""
    own = {1: [5], 2: [5, 6], 3: [6, 7, 8], 4: [8, 6, 7], 5: []}
    rows = spark.createDataFrame([(p, i) for p, ids in own.items() for i in ids], "path long, id long")
    met = ND._met(rows)
    got = met.collect()
    assert sorted((r.path, r.id, r.n) for r in got) == [
        (p, i, len(ids)) for p, ids in own.items() for i in sorted(ids) if len(ids) > 1
    ]
    assert len({(r.n, r.in_a, r.in_b) for r in got}) == 2
    plan = met._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_nodes_of_different_levels_with_the_same_members_are_one(spark):
    r = np.random.default_rng(11)
    core = r.integers(0, 2**32, ND.SIZE, dtype=np.uint32)
    rows = []
    for i in range(40):
        own = core.copy()
        own[r.choice(ND.SIZE, 8, replace=False)] = i // 2
        rows.append((i, own.tobytes()))
    marks = spark.createDataFrame(rows, "id long, sketch binary")
    found, _ = ND.nodes(marks, 80, 6, 4, 24)
    members = {}
    for level, part in enumerate(found):
        for x in part.collect():
            members.setdefault((level, x.path), set()).add(x.id)
    assert len(members) > 1 and all(1 < len(m) <= 4 for m in members.values())
    assert len({frozenset(m) for m in members.values()}) == len(members)
