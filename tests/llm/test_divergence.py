"""Source divergence against plain arithmetic on small tables."""

import collections
import random
import re

import pytest

from linkloom.llm import divergence
from linkloom.llm.common import ready
from tests.llm import plain

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ROWS = "doc_id long, text string, lang string, source string, value long, rank int, no long, total string"


def audit(rows, least=3, top=200):
    """The contract word by word, with Python's whole numbers."""
    docs = [((lang or ""), (source or ""), TERM.findall((text or "").translate(plain.LOWER))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = collections.Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= least}
        v = len(kept)
        count = collections.defaultdict(collections.Counter)
        for _, source, terms in own:
            count[source].update(t for t in terms if t in kept)
        every = sum(count.values(), collections.Counter())

        def p(counter, term):
            return 1 + 10**9 * (counter[term] + 1) // (sum(counter.values()) + v)

        def f(a, b):
            return (a - b) ** 2 // b

        for source in count:
            pairs = [(o, sum(f(p(count[source], t), p(count[o], t)) for t in kept)) for o in count if o != source]
            terms = [
                (t, f(p(count[source], t), p(every, t)))
                for t in kept
                if count[source][t] and p(count[source], t) > p(every, t)
            ]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)}
    return out


def some_rows(n, seed, words, sources=7):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(["en", "en", "en", "dé", "", None])
        source = "hot" if r.random() < 0.4 else f"s{r.randrange(sources)}"
        text = " ".join(r.choice(words) for _ in range(r.choice([0, 1, 5, 40])))
        rows.append((text if r.random() > 0.05 else None, lang, source if r.random() > 0.1 else None))
    rows += [("only once", "xx", "alone"), (None, "yy", "a"), ("", "yy", "b"), ("1 2 3", "zz", "digits")]
    rows += [rows[3]] * 6  # repeated rows
    return rows


WORDS = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["École", "École", "ß", "日本", "A-B", "x1y", "THE", "the", "\x7f", "é_è"]


def frame(spark, rows):
    return ready(spark).createDataFrame([(i, *r, 5, 6, 7, "t") for i, r in enumerate(rows)], ROWS)


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence(spark, seed):
    rows = some_rows(250, seed, WORDS)
    out = divergence.divergence(frame(spark, rows))
    assert {tuple(r) for r in out.collect()} == audit(rows)


def test_few_ranks_and_small_tiles(spark):
    rows = some_rows(200, 3, WORDS, sources=9)
    docs = frame(spark, rows)
    want = audit(rows, least=2, top=4)
    counts = divergence.term_counts(docs, 2)
    groups = divergence._totals(docs, counts)
    near = divergence.source_distances(counts, groups, sources=3, terms=10)
    assert {tuple(r) for r in near.collect()} == {(a, b, i, v, k) for a, b, part, i, v, k in want if part == "pair"}
    own = divergence.term_ranks(counts, groups, 4)
    assert {tuple(r) for r in own.collect()} == {(a, b, i, v, k) for a, b, part, i, v, k in want if part == "term"}


def test_long_texts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 1 << 12)
    rows = [(" ".join(WORDS) * 400, "en", "long"), *some_rows(40, 4, WORDS)]
    out = divergence.divergence(frame(spark, rows))
    assert {tuple(r) for r in out.collect()} == audit(rows)


def test_empty_table(spark):
    assert divergence.divergence(frame(spark, [])).collect() == []
    assert divergence.divergence(frame(spark, [(None, None, None)])).collect() == []


def test_shares_of_large_counts(spark):
    import numpy as np

    for count, total in ((0, 1), (6, 7), (3 * 10**14, 9 * 10**14 + 7), (8 * 10**15, 9 * 10**15)):
        want = 1 + 10**9 * (count + 1) // total
        assert divergence._share_of(np.array([count]), total).tolist() == [want]
        row = spark.range(1).select(divergence._share(
            divergence.F.lit(count).cast("long"), divergence.F.lit(total).cast("long")
        ).alias("p")).first()
        assert row.p == want
