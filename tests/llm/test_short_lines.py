"""Lines by their five-character shingles."""

from linkloom.llm import line_dedup
from linkloom.llm.common import ready
from tests.llm import plain


def test_a_letter_changed_in_a_line_of_49_characters_or_more(spark):
    docs = []
    for k, n in enumerate((40, 48, 49, 56, 60)):
        line = "".join(chr(0x4E00 + 100 * k + i) for i in range(n))
        docs += [(2 * k, line), (2 * k + 1, line[: n // 2] + "7" + line[n // 2 + 1 :])]
    rows = ready(spark).createDataFrame(docs, "doc_id long, text string")
    got = {tuple(r)[:4] for r in line_dedup.repeated_lines(rows).collect()}
    sets = {i: frozenset(t[k : k + 5] for k in range(len(t) - 4)) for i, t in docs}
    parts = plain.linked(sets)
    assert got == {(i, 0, parts.top(i), 0) for i in sets if parts.top(i) != i}
    assert {r[0] for r in got} == {5, 7, 9}


def test_rows_of_one_id_are_told_apart(spark):
    """Only the text that repeats loses its line, equal rows stay as they are, rows without id take no part."""
    x, y = "a line that is there more than once", "quite another line, and nowhere else"
    rows = [(1, x), (2, x), (2, y), (3, y[:-1] + "E"), (3, y[:-1] + "E"), (None, x), (None, None), (4, None), (5, "")]
    docs = ready(spark).createDataFrame([(*r, 7, "n") for r in rows], "doc_id long, text string, row int, gone string")
    found = line_dedup.repeated_lines(docs)
    assert {tuple(r)[:4] for r in found.collect()} == {(2, 0, 1, 0), (3, 0, 2, 0)}
    left = line_dedup.without_lines(docs, found)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(1, x), (2, y), (None, x), (None, None), (4, None), (5, "")], key=str
    )


def test_blocks_buckets_and_common_bands(spark, monkeypatch):
    """Small blocks and buckets, a template that many lines are made from, and lines that chain."""
    monkeypatch.setattr(line_dedup, "BLOCK", 7)
    monkeypatch.setattr(line_dedup, "BUCKET", 50)
    base = "the quick brown fox jumps over the lazy dog and then it runs away from page %d of this long book"
    docs = [(i, "\n".join([base % i, f"alone {i * i * 7919} in its own line {i}", "short", ""])) for i in range(40)]
    rows = ready(spark).createDataFrame(docs, "doc_id long, text string")
    for limit in (1024, 6):
        got = {tuple(r)[:4] for r in line_dedup.repeated_lines(rows, limit=limit).collect()}
        assert got == plain.repeated_lines(docs)
