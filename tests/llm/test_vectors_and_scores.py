"""Searches, quality scores, mixing, chat and the pipeline against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkloom.llm import chat, exact_search, mixing, neighbours, quality
from linkloom.llm.common import ready, table
from linkloom.llm.components import components
from tests.llm import plain

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, score double, shard int, is_query boolean"


def vectors(spark, n=400, d=12, seed=4):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)).astype(np.float32)
    x[50:150] = x[50]  # copies, so ties
    x[n - 3 :] *= 20
    rows = [(i, [float(v) for v in row], 0.0, 0, True) for i, row in enumerate(x)]
    odd = [None, [], [float("nan")] * d, [float("inf"), *[0.0] * (d - 1)], [None, *[1.0] * (d - 1)]]
    rows += [(1000 + 20 * i, v, 0.0, 0, True) for i, v in enumerate(odd)]
    rows += [(None, [1.0] * d, 0.0, 0, True), (2000, [0.0] * d, 0.0, 0, True), rows[60], rows[0]]
    return ready(spark).createDataFrame(rows, VECTORS), x


def test_exact_search(spark):
    table_, x = vectors(spark)
    out = exact_search.exact_top_k(table_, F.col("vec_id") % 10 == 0, k=7, scale=1024.0, shard_rows=60)
    whole = np.vstack([np.floor(1024 * x.astype(float)), np.zeros(x.shape[1])]).astype(np.int64)
    names = np.r_[np.arange(len(x)), 2000]
    want = set()
    for q in np.flatnonzero(names % 10 == 0):
        scores = whole @ whole[q]
        order = [j for j in np.lexsort((names, -scores)) if j != q][:7]
        want |= {(int(names[q]), k + 1, int(names[j]), int(scores[j])) for k, j in enumerate(order)}
    assert {tuple(r) for r in out.collect()} == want


def test_exact_search_of_large_components(spark):
    rows = [(i, [1e15 * (i + 1), 3.0]) for i in range(4)]
    table_ = ready(spark).createDataFrame(rows, "vec_id long, embedding array<double>")
    out = exact_search.exact_top_k(table_, F.col("vec_id") == 0, k=3, scale=1.0).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [1, 2, 3] and {r.score for r in out} == {2**63 - 1}


def test_neighbours_of_odd_vectors(spark):
    table_, x = vectors(spark)
    out = neighbours.nearest_neighbours(table_, F.col("vec_id") % 20 == 0, k=20).collect()
    by = {}
    for r in out:
        by.setdefault(r.query_id, []).append(r)
    assert by.keys() == set(range(0, 400, 20))
    x = x.astype(float)
    hits = 0
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21)) and q not in {r.vec_id for r in rows}
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        for r in rows:
            assert math.isclose(r.score, x[q] @ x[r.vec_id], rel_tol=1e-12, abs_tol=1e-12)
        scores = x @ x[q]
        best = [j for j in np.lexsort((np.arange(400), -scores)) if j != q][:20]
        hits += len({r.vec_id for r in rows} & set(best))
    assert hits >= 0.95 * 400


def test_recall_over_shards(spark):
    vecs = table(ready(spark), SF, "embeddings")
    index, shards = neighbours.build_index(vecs, shard_rows=100)
    assert shards > 1
    found = neighbours.nearest(index, shards, vecs.filter("vec_id % 20 == 0"), k=20).collect()
    rows = vecs.select("vec_id", "embedding").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    want = set()
    for q in range(0, len(x), 20):
        order = [j for j in np.lexsort((np.arange(len(x)), -(x @ x[q]))) if j != q][:20]
        want |= {(q, int(j)) for j in order}
    assert len(want & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * len(want)


def test_empty_vectors(spark):
    none = ready(spark).createDataFrame([], VECTORS)
    assert exact_search.exact_top_k(none, F.lit(True), 5, 1.0).count() == 0
    assert neighbours.nearest_neighbours(none, F.lit(True), 5).count() == 0


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 300), r.randrange(100, 300)) for _ in range(120)]
    links += [(5000, i) for i in range(5001, 5100)] + [(7, 7), (2, 1), (1, 2)]
    parts = plain.Union({i for x in links for i in x})
    for a, b in links:
        parts.join(a, b)
    got = components(ready(spark).createDataFrame(links, "a long, b long")).collect()
    want = {(i, parts.top(i)) for x in links if x[0] != x[1] for i in x}
    assert sorted(map(tuple, got)) == sorted(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality_on_held_out_documents(spark):
    out = quality.op3_quality_discriminant(spark, SF)
    rows = out.join(table(spark, SF, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)


def test_quality_equals_a_plain_discriminant(spark):
    """Statistics, class covariances and scores of all documents, each worked out the plain way."""
    import zlib

    docs = {r.doc_id: r.text for r in table(ready(spark), SF, "documents").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = {d: plain.quality_statistics(t) for d, t in docs.items()}
    learn = [d for d in docs if labels.get(d) in (0, 1) and zlib.crc32(str(d).encode()) % 4 != 2]
    score = plain.discriminant(
        [rows[d] for d in learn], [labels[d] for d in learn], quality.SHRINK, quality.SPHERE, quality.SLOPE
    )
    out = quality.op3_quality_discriminant(spark, SF).collect()
    assert len(out) == len(docs)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert math.isclose(r.score, score(rows[r.doc_id]), abs_tol=1e-6)


def test_quality_of_odd_texts(spark):
    docs = [(i, t, 0.1, [1.0]) for i, t in enumerate([None, "", " \n", "x", "!" * 5000, "A b. " * 90000])]
    docs += [(None, "no id", 0.1, None), docs[3]]
    frame = ready(spark).createDataFrame(docs, "doc_id long, text string, score double, statistics array<double>")
    labels = spark.createDataFrame([(1, 1), (3, 7), (4, None)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0), table(spark, SF, "labels").select("doc_id", "quality")):
        out = quality.quality_scores(frame, marks).collect()
        assert len(out) == len(docs) and all(0 <= r.score <= 1 for r in out)
    assert quality.quality_scores(frame.limit(0), labels).count() == 0
    kept = quality.good_documents(frame, labels.limit(0), cut=0.5)
    assert kept.columns == frame.columns and kept.count() == len(docs)


def sources(spark, sizes):
    rows = [(d, s, "w " * (d % 7), "e") for s, n in sizes.items() for d in range(n)]
    rows = [(i, s, t, e) for i, (_, s, t, e) in enumerate(rows)]
    return ready(spark).createDataFrame(rows, "doc_id long, source string, text string, passes string")


@pytest.mark.parametrize("target", [mixing.Target(repeats=3), mixing.Target(entropy=0.9), mixing.Target(budget=500)])
def test_mixing_meets_its_target(spark, target):
    docs = sources(spark, {"a": 400, "b": 60, None: 90, "c": 1})
    plan = {r.source: r for r in mixing.weights(docs, target).collect()}
    drawn = mixing.mixed(docs, target).select("row.*", "pass", "place_key").collect()
    assert math.isclose(sum(r.weight for r in plan.values()), 1)
    if target.repeats:
        assert max(r.quota / r.n for r in plan.values() if r.n) <= 3 + 1e-3
    if target.entropy:
        entropy = -sum(r.weight * math.log(r.weight) for r in plan.values() if r.n)
        assert entropy >= 0.9 * math.log(3) - 1e-6
    if not target.budget:  # nothing is left out
        assert {r.doc_id for r in drawn} == {r.doc_id for r in docs.collect()}
    for s, r in plan.items():
        own = [d for d in drawn if d.source == s]
        tokens = sum(len((d.text or "").split()) for d in own)
        longest = 6
        assert r.quota - longest <= tokens <= r.quota
        assert max((d["pass"] for d in own), default=0) <= r.passes + 1
        last = [d for d in own if d["pass"] == r.passes + 1]
        rest = {d.place_key for d in docs.select("*", mixing._key(target.seed, F.lit(r.passes + 1), F.col("doc_id")).alias("place_key")).filter(F.col("source").eqNullSafe(F.lit(s))).collect()}
        assert {d.place_key for d in last} == set(sorted(rest)[: len(last)])


def test_sources_without_words_have_no_say(spark):
    """One source of a wordless row and one of a single word beside large ones; both targets at once."""
    rows = [(i, "big" if i < 2000 else "small", "w " * 10) for i in range(2600)]
    rows += [(3000, "none", None), (3001, "none", "  "), (3002, None, "")]
    docs = ready(spark).createDataFrame(rows, "doc_id long, source string, text string")
    target = mixing.Target(entropy=0.97, repeats=2.5)
    plan = {r.source: r for r in mixing.weights(docs, target).collect()}
    alone = {r.source: r for r in mixing.weights(docs.filter("doc_id < 3000"), target).collect()}
    assert {s: plan[s] for s in alone} == alone
    for s in ("none", None):
        assert (plan[s].n, plan[s].weight, plan[s].quota, plan[s].passes, plan[s].rest) == (0, 0.0, 0, 1, 0)
    drawn = mixing.mixed(docs, target).filter("row.doc_id >= 3000").select("row.doc_id", "pass").collect()
    assert sorted(map(tuple, drawn)) == [(3000, 1), (3001, 1), (3002, 1)]
    only = docs.filter("doc_id >= 3000")
    assert sorted(map(tuple, mixing.mixed(only, target).select("row.doc_id", "pass").collect())) == [(3000, 1), (3001, 1), (3002, 1)]


def test_ties_in_the_cut_pass(spark):
    """Copies of one row have one key: they are drawn together, or not at all."""
    rows = [(i // 5, "a", "w w w") for i in range(200)] + [(1000 + i, "b", "w " * 9) for i in range(100)]
    docs = ready(spark).createDataFrame(rows, "doc_id long, source string, text string")
    drawn = mixing.mixed(docs, mixing.Target(budget=700)).select("row.doc_id", "row.source", "pass").filter("source = 'a'").collect()
    counts = {}
    for r in drawn:
        counts[r.doc_id, r["pass"]] = counts.get((r.doc_id, r["pass"]), 0) + 1
    assert counts and set(counts.values()) == {5}


def test_mixing_of_odd_tables(spark):
    docs = [(None, None, None), (None, None, None), (1, "a", ""), (2, "a", None), (3, "b", "x y")]
    frame = ready(spark).createDataFrame(docs, "doc_id long, source string, text string")
    assert mixing.mixed(frame, mixing.Target(repeats=2)).filter("pass = 1").count() == 5
    assert mixing.mixed(frame.limit(0), mixing.MIX).count() == 0


def test_reply_trees(spark):
    #       1          9 (missing parent)      20 <-> 21 (a circle)
    #     2   3        |
    #     4   5 6      10
    rows = [(1, None, 0.0), (2, 1, 1.0), (3, 1, 0.5), (4, 2, 1.0), (5, 3, 9.0), (6, 3, None), (10, 9, None)]
    rows += [(20, 21, 1.0), (21, 20, 1.0), (30, None, None)]
    trees = {**dict.fromkeys(range(1, 7), "t"), 10: "u", 20: "v", 21: "v", 30: None}
    frame = ready(spark).createDataFrame([(i, p, s, trees[i]) for i, p, s in rows], "id long, parent long, score double, tree string")
    got = {(r.leaf, r.id, r.height) for r in chat.paths(frame).collect()}
    assert got == {(4, 4, 0), (4, 2, 1), (4, 1, 2), (5, 5, 0), (5, 3, 1), (5, 1, 2), (6, 6, 0), (6, 3, 1), (6, 1, 2), (10, 10, 0), (30, 30, 0)}
    best = {(r.tree, r.branch, r.id, r.place) for r in chat.chosen_paths(frame, best=2).collect()}
    assert {x for x in best if x[0] == "t"} == {("t", 1, 1, 0), ("t", 1, 3, 1), ("t", 1, 5, 2), ("t", 2, 1, 0), ("t", 2, 2, 1), ("t", 2, 4, 2)}


def test_formats_are_reversible(spark):
    r = random.Random(9)
    bits = ["<", "|", ">", "\n", "\\", "[", "]", "</s>\n", "[INST]", "<|user|>\n", "é", "😀", "a", ""]
    talk = [(c, t, r.choice(["user", "assistant", "<|a|>\n", "", None]), r.choice([None, "".join(r.choices(bits, k=9))])) for c in range(40) for t in range(5)]
    talk += [(None, None, None, None), (3, 2, "user", "again"), (3, 2, "user", "again"), (50, 0, "assistant", "x" * 100_000)]
    frame = ready(spark).createDataFrame(talk, "conv_id long, turn int, role string, text string").withColumn("id", F.lit("clash"))
    out = chat.conversations(frame).select("*", chat.parsed(F.col("formatted")).alias("turns"), chat.under_loss(F.col("formatted"), F.col("loss")).alias("said")).collect()
    by = {}
    null_first = lambda x: (x is not None, x)
    for c, t, role, text in sorted(talk, key=lambda x: tuple(map(null_first, x))):
        by.setdefault(c, []).append((role or "", text or ""))
    assert {o.conv_id: [tuple(t) for t in o.turns] for o in out} == by
    for o in out:
        assert o.said == "".join(t for role, t in by[o.conv_id] if role == "assistant")
    assert chat.conversations(frame.limit(0)).count() == 0


def test_chat_digests(spark):
    rows = {r.conv_id: r for r in chat.op2_reply_tree_chat(spark, "/root/testdata/sf0.001").collect()}
    text = "</s>[INST] ok [/INST]"
    assert rows[-1].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert rows[-1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and rows[-1].loss_chars == len(text)


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(ready(spark), sf, "documents")
    quality_, lines, near, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    kept = quality_(spark, docs, sf)
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    assert all((d in left) == bool(q) for d, q in labels.items())

    cleaned = lines(spark, kept, sf)
    assert cleaned.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    gone = {}
    for d, n, _, _ in plain.repeated_lines(list(texts.items())):
        gone.setdefault(d, set()).add(n)
    want = {}
    for d, t in texts.items():
        own = [x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ())]
        if d not in gone or any(x.strip() for x in own):
            want[d] = "\n".join(own)
    got = {r.doc_id: r for r in cleaned.collect()}
    assert {d: r.text for d, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())

    doubled = docs.unionByName(docs.filter("doc_id < 3").withColumn("doc_id", F.col("doc_id") + 10_000))
    unique = near(spark, doubled, sf)
    parts = plain.near_duplicates([(r.doc_id, r.text) for r in doubled.collect()], 5)
    assert {r.doc_id for r in unique.collect()} == {d for d, (_, c) in parts.items() if d == c}

    # Rows of one id are one document: they stay or go together.
    same = docs.filter("doc_id < 2").unionByName(docs.filter("doc_id < 2"))
    assert near(spark, same, sf).count() == 2 * near(spark, docs.filter("doc_id < 2"), sf).count()

    drawn = mix(spark, docs, sf)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in docs.collect()}
    pieces = pack(spark, drawn, sf)
    assert pieces.agg(F.sum("length")).first()[0] == pieces.filter("start = 0").agg(F.sum("doc_tokens")).first()[0]


def test_whole_pipeline(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_stages_of_an_empty_table_and_of_clashing_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(ready(spark), sf, "documents")
    extra = docs.filter("doc_id < 40")
    for name in ("row", "gone", "kept", "id", "path", "component", "pass"):
        extra = extra.withColumn(name, F.lit(name))
    for given in (docs.limit(0), extra):
        rows = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, sf)
            assert rows.columns == given.columns
        pieces = corpus_pipeline.STAGES[-1][1](spark, rows, sf)
        assert (pieces.count() > 0) == (given is extra)


def test_the_classifier_is_fitted_on_written_statistics(spark, monkeypatch):
    """Not in the task that computes them: two Python steps there would need two workers at once."""
    rows = [(i, f"{'a b c.' * (i % 5)} {i}") for i in range(40)] + [(None, None), (3, "again")]
    docs = ready(spark).createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 40, 3)], "doc_id long, quality int")
    plans, fitted = [], quality.fitted

    def watched(labelled):
        plans.append(labelled._jdf.queryExecution().executedPlan().toString())
        return fitted(labelled)

    monkeypatch.setattr(quality, "fitted", watched)
    kept = quality.good_documents(docs, labels).collect()
    scored = quality.quality_scores(docs, labels).filter("predicted = 1").collect()
    assert len(plans) == 2 and not any("MapInArrow" in p for p in plans)
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(r.doc_id) for r in scored)
