"""The token-group join against brute force."""

import random

import pytest

from linkloom.llm import group_join
from linkloom.llm.common import ready, table
from tests.llm import plain

ROWS = "doc_id long, text string, id long, n long, code string, component string, grp int"


def components(docs, width, percent):
    """Rows of one id are one document; every pair of sets is compared by the plain join."""
    sets = {(i, k): plain.shingles(t, width) for k, (i, t) in enumerate(docs) if i is not None}
    parts = plain.linked(sets, percent)
    by_id = {}
    for at in sets:
        if at[0] in by_id:
            parts.join(at, by_id[at[0]])
        by_id.setdefault(at[0], at)
    return [(i, len(sets[i, k]), parts.top((i, k))[0]) if i is not None else (None, len(plain.shingles(t, width)), None) for k, (i, t) in enumerate(docs)]


def frame(spark, docs):
    return ready(spark).createDataFrame([(*d, 1, 2, "c", "x", 3) for d in docs], ROWS)


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def varied(r, words, share):
    return [w if r.random() > share else f"new{r.randrange(10**6)}" for w in words]


@pytest.fixture(scope="module")
def crafted():
    """A large group of near copies, chains at the threshold, a passage that many share, odd rows."""
    r = random.Random(7)
    word = [f"w{i}" for i in range(400)]
    base = [r.choice(word) for _ in range(120)]
    passage = [r.choice(word) for _ in range(40)]
    docs = [" ".join(varied(r, base, 0.004)) for _ in range(150)]
    docs += [" ".join([r.choice(word) for _ in range(r.randrange(60, 90))] + passage) for _ in range(80)]
    step = [r.choice(word) for _ in range(100)]
    for _ in range(30):
        docs.append(" ".join(step))
        at = r.randrange(96)
        step = step[:at] + [f"z{r.randrange(10**6)}"] + step[at + 1 :]
    docs += [" ".join(r.choice(word) for _ in range(n)) for n in (1, 2, 3, 4, 5, 3000)]
    docs += ["same few", "Same  FEW", "same\tfew words here", "", "  \n", None] + [docs[5]] * 40
    rows = [(3 * i, t) for i, t in enumerate(docs)]
    r.shuffle(rows)
    rows += [(None, docs[0]), (None, None), rows[0], (rows[1][0], docs[3]), (rows[1][0], "quite another text of its own")]
    return rows


@pytest.mark.parametrize("width, percent, members", [(4, 85, 8), (5, 85, 64), (3, 70, 4)])
def test_group_join(spark, crafted, width, percent, members):
    out = group_join.group_join(frame(spark, crafted), width, percent, members).collect()
    assert key(out) == key(components(crafted, width, percent))


def test_many_blocks_and_buckets(spark, crafted, monkeypatch):
    monkeypatch.setattr(group_join, "BLOCK", 500)
    monkeypatch.setattr(group_join, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(group_join, "ASKERS", 3)
    out = group_join.group_join(frame(spark, crafted), 4, 85, 8).collect()
    assert key(out) == key(components(crafted, 4, 85))


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    out = group_join.op13_group_join(spark, sf).collect()
    assert out[0].__fields__ == ["doc_id", "n_shingles", "component_id"]
    assert key(out) == key(components(docs, 4, 85))
    assert any(r.component_id != r.doc_id for r in out)


def test_empty_table(spark):
    assert group_join.group_join(frame(spark, [])).collect() == []
    assert key(group_join.group_join(frame(spark, [(4, None), (5, "")])).collect()) == [(4, 0, 4), (5, 0, 5)]
