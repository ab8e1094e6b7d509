"""Which terms set a source apart from its language, and how far sources are from each other.

Terms are counted per (lang, source) in whole blocks of text that are dealt by group, so that a hot group is
spread over many tasks and each block is summed before anything is shuffled. Terms of a group with the same
pair of counts form a cell: a divergence is evaluated once for each cell, cells are ranked by how many terms
they hold, cells of equal value become one, and only terms of ranked cells are written out, in UTF-8 order.
For two sources the cells are the joint counts of a tile: a block of terms and two blocks of sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.common import partitions, ready, saved, table, text_pieces, written
from linkloom.llm.nodes import groups as runs_of
from linkloom.llm.words import LOWER, word_spans
from linkloom.session import own_side

LEAST_DOCS = 3  # documents of a language that a kept term is in
TOP = 200
SCALE_STEPS = 3  # p counts in units of 1000 ** -SCALE_STEPS
BLOCK_BYTES = 16 << 20  # text summed at once in a task
BLOCK_ROWS = 1 << 16
SOURCES = 64  # sources of one side of a tile
TERMS = 16384  # terms of a tile, on average
# Everything but the letters A-Z, a-z and the bytes of characters beyond ASCII parts terms.
PARTS = np.zeros(256, bool)
PARTS[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

TILE = ("lang", "slice", "i", "j")
_COUNTS = "lang string, source string, term string, c long, df long"
_SUMS = "lang string, a string, b string, total long, met long"


def _strings(letters: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Strings of these sizes, one after the other in ``letters``."""
    offsets = np.r_[0, np.cumsum(sizes)]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(letters))


def _summed(parts: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]) -> pa.RecordBatch | None:
    """``lang, source, term, c, df`` of a block of texts; ``df`` is the number of texts with the term."""
    whole = pa.Table.from_batches([p for p, _, _ in parts]).combine_chunks()
    data = np.concatenate([d for _, d, _ in parts])
    sizes = np.concatenate([np.diff(o) for _, _, o in parts])
    offsets = np.r_[0, np.cumsum(sizes)]
    starts, ends, firsts = word_spans(data, offsets, PARTS)
    if len(starts) == 0:
        return None
    term = _strings(LOWER[data[~PARTS[data]]], ends - starts).dictionary_encode()
    lang = whole.column("lang").combine_chunks().dictionary_encode()
    source = whole.column("source").combine_chunks().dictionary_encode()
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    row = np.repeat(np.arange(len(sizes)), np.diff(firsts))
    n_terms, n_rows = len(term.dictionary), len(sizes)
    own = group[row] * n_terms + term.indices.to_numpy()
    key = np.sort(own * n_rows + row)
    own = key // n_rows
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    new_row = np.r_[True, key[1:] != key[:-1]]
    found = own[first]
    at = found // n_terms
    return pa.record_batch(
        [
            lang.dictionary.take(pa.array(at // len(source.dictionary))),
            source.dictionary.take(pa.array(at % len(source.dictionary))),
            term.dictionary.take(pa.array(found % n_terms)).cast(pa.string()),
            pa.array(np.diff(np.r_[first, len(own)])),
            pa.array(np.add.reduceat(new_row.astype(np.int64), first)),
        ],
        names=["lang", "source", "term", "c", "df"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, rows = [], 0, 0
    for piece in text_pieces(batches):
        held.append(piece)
        size += len(piece[1])
        rows += piece[0].num_rows
        if size >= BLOCK_BYTES or rows >= BLOCK_ROWS:
            out = _summed(held)
            held, size, rows = [], 0, 0
            if out is not None:
                yield from pa.Table.from_batches([out]).to_batches(max_chunksize=1 << 16)
    if held and (out := _summed(held)) is not None:
        yield from pa.Table.from_batches([out]).to_batches(max_chunksize=1 << 16)


def term_counts(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, term, c, lang_c, first, no`` of kept terms, written to the shared folder.

    ``first`` marks one row of each (lang, term), ``no`` numbers them (with gaps). Documents are dealt in
    ranges of (lang, source), so a task sums few groups and a large group is spread over many tasks.
    """
    spark = docs.sparkSession
    bare = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]
    dealt = (
        docs.select(*bare, F.monotonically_increasing_id().alias("at"))
        .repartitionByRange(partitions(spark), "lang", "source", "at")
        .sortWithinPartitions("lang", "source")
        .drop("at")
    )
    # One shuffle: sums of a term and those of all its sources are made where the term lies.
    each = (
        dealt.mapInArrow(_blocks, _COUNTS)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("c").alias("c"), F.sum("df").alias("df"))
    )
    of = Window.partitionBy("lang", "term")
    rows = each.withColumn("row", F.monotonically_increasing_id()).select(
        "lang",
        "source",
        "term",
        "c",
        F.sum("c").over(of).alias("lang_c"),
        F.sum("df").over(of).alias("lang_df"),
        "row",
        F.min("row").over(of).alias("no"),
    )
    kept = rows.filter(F.col("lang_df") >= least)
    return written(
        kept.select("lang", "source", "term", "c", "lang_c", (F.col("row") == F.col("no")).alias("first"), "no"),
        "term-counts",
    )


def _share(count: Column, total: Column) -> Column:
    """1 + floor(10**9 * (count + 1) / total) in whole numbers that stay below 2**63."""
    rest, out = count + 1, F.lit(0).cast("long")
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        out = out * 1000 + _div(rest, total)
        rest = rest % total
    return out + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share_of(count: np.ndarray, total: int) -> np.ndarray:
    """``_share`` of an array."""
    rest, out = count + 1, np.zeros_like(count)
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _apart(p, q):
    """(p - q) ** 2 / q, rounded down; p and q are at most 10**9 + 1."""
    return _div((p - q) * (p - q), q) if isinstance(p, Column) else (p - q) * (p - q) // q


def _totals(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per (lang, source): ``total`` is N + V, with ``v, lang_total, n_sources`` of its lang."""
    seen = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("c").alias("n"), F.count_if("first").alias("v"))
    known = saved(seen.join(sums, ["lang", "source"], "left").fillna(0, ["n", "v"]))
    langs = known.groupBy("lang").agg(
        F.sum("v").alias("v"),
        (F.sum("v") + F.sum("n")).alias("lang_total"),
        F.count("*").alias("n_sources"),
    )
    groups = known.drop("v").join(own_side(langs), "lang")
    return saved(groups.withColumn("total", F.col("n") + F.col("v")).drop("n"))


def term_ranks(counts: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, term, value, rank`` of the ``top`` terms of each group that it has more of."""
    cells = counts.groupBy("lang", "source", "c", "lang_c").agg(F.count("*").alias("terms"))
    p, q = _share(F.col("c"), F.col("total")), _share(F.col("lang_c"), F.col("lang_total"))
    valued = (
        cells.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
        .withColumn("p", p)
        .withColumn("q", q)
        .filter("p > q")
        .withColumn("value", _apart(F.col("p"), F.col("q")))
        .select("lang", "source", "c", "lang_c", "terms", "value")
    )
    valued = saved(valued)
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # Each value holds a term at least, so values beyond the first ``top`` have no rank to give.
    ahead = (
        merged.withColumn("nth", F.row_number().over(falling))
        .filter(F.col("nth") <= top)
        .withColumn("ahead", F.sum("terms").over(falling.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("ahead", F.coalesce("ahead", F.lit(0)))
        .filter(F.col("ahead") < top)
        .select("lang", "source", "value", "ahead")
    )
    ranked = saved(valued.drop("terms").join(ahead, ["lang", "source", "value"]))
    terms = counts.select("lang", "source", "c", "lang_c", "term").join(
        ranked, ["lang", "source", "c", "lang_c"]
    )
    spelt = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (
        terms.withColumn("nth", F.row_number().over(spelt))
        .filter(F.col("nth") <= top)
        .withColumn("rank", (F.col("ahead") + F.col("nth")).cast("int"))
        .filter(F.col("rank") <= top)
        .select("lang", "source", "term", "value", "rank")
    )


def _tile_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the terms of a tile for each ordered pair of its sources."""
    for tile in runs_of(batches, *TILE):
        tile = tile.combine_chunks()
        source = tile.column("source").combine_chunks().dictionary_encode()
        at = source.indices.to_numpy().astype(np.int64)
        names, width = source.dictionary, len(source.dictionary)
        c = tile.column("c").to_numpy()
        total, block = np.zeros((2, width), np.int64)
        total[at] = tile.column("total").to_numpy()
        block[at] = tile.column("block").to_numpy()
        marks = c == 0
        _, term = np.unique(tile.column("no").to_numpy()[~marks], return_inverse=True)
        n = int(term.max()) + 1 if len(term) else 0
        counts = np.zeros((width, n), np.int64)
        counts[at[~marks], term] = c[~marks]
        sides = [np.unique(row, return_inverse=True) for row in counts]
        shares = [_share_of(values, int(total[k])) for k, (values, _) in enumerate(sides)]
        crossed = tile.column("i")[0].as_py() != tile.column("j")[0].as_py()
        out = []
        for a in range(width):
            for b in range(width):
                if a == b or crossed and block[a] == block[b]:
                    continue
                wide = len(sides[b][0])
                joint = sides[a][1] * wide + sides[b][1]
                if len(sides[a][0]) * wide <= 4 * n:
                    terms = np.bincount(joint, minlength=len(sides[a][0]) * wide)
                    cell = np.flatnonzero(terms)
                    terms = terms[cell]
                else:
                    cell, terms = np.unique(joint, return_counts=True)
                one, two = cell // wide, cell % wide
                some = (sides[a][0][one] > 0) | (sides[b][0][two] > 0)
                value = _apart(shares[a][one[some]], shares[b][two[some]])
                out.append((a, b, int((value * terms[some]).sum()), int(terms[some].sum())))
        if out:
            a, b, total_, met = (np.array(x, np.int64) for x in zip(*out))
            lang = pa.array([tile.column("lang")[0].as_py()] * len(a), pa.string())
            yield pa.record_batch(
                [lang, names.take(pa.array(a)), names.take(pa.array(b)), pa.array(total_), pa.array(met)],
                names=["lang", "a", "b", "total", "met"],
            )


def source_distances(
    counts: DataFrame, groups: DataFrame, sources: int = SOURCES, terms: int = TERMS
) -> DataFrame:
    """``lang, source, other, value, rank``: all other sources of the language, the farthest first.

    A tile holds about ``terms`` terms and two blocks of about ``sources`` sources, whatever the size of a
    language. Terms that neither source has are counted, not visited.
    """
    none = F.lit(0).cast("long")
    known = (
        groups.withColumn("blocks", F.ceil(F.col("n_sources") / sources))
        .withColumn("slices", F.ceil(F.col("v") / terms))
        .withColumn("block", F.pmod(F.xxhash64("source"), "blocks"))
        .select("lang", "source", "total", "blocks", "slices", "block")
    )
    rows = counts.select("lang", "source", "no", "c").join(known, ["lang", "source"])
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("no"), "slices"))
    # Every source is in every slice, so that a pair sees the terms that one of them lacks.
    marks = known.filter("slices > 0").select(
        "*",
        none.alias("no"),
        none.alias("c"),
        F.explode(F.sequence(none, F.col("slices") - 1)).alias("slice"),
    )
    beside = F.explode(F.sequence(none, F.col("blocks") - 1))
    dealt = rows.unionByName(marks).withColumn("beside", beside).select(
        "lang",
        "slice",
        F.least("block", "beside").alias("i"),
        F.greatest("block", "beside").alias("j"),
        "source",
        "block",
        "total",
        "no",
        "c",
    )
    sums = (
        dealt.repartition(*TILE)
        .sortWithinPartitions(*TILE)
        .mapInArrow(_tile_sums, _SUMS)
        .groupBy("lang", "a", "b")
        .agg(F.sum("total").alias("total"), F.sum("met").alias("met"))
    )
    one = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "v")
    two = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = one.join(two, "lang").filter("a != b").join(sums, ["lang", "a", "b"], "left")
    absent = F.col("v") - F.coalesce("met", none)
    apart = _apart(_share(none, F.col("total_a")), _share(none, F.col("total_b")))
    value = F.when(F.col("v") > 0, F.coalesce("total", none) + absent * apart).otherwise(none)
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("other"))
    return pairs.select(
        "lang", F.col("a").alias("source"), F.col("b").alias("other"), value.alias("value")
    ).withColumn("rank", F.row_number().over(falling))


def divergence(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs(lang, source, text)``.

    Terms are runs of letters and of characters beyond ASCII, with A-Z lower-cased; a language keeps the V
    terms in at least ``least`` of its rows. A group (lang, source), or a whole language, gives a kept term
    p = 1 + floor(10**9 * (count + 1) / (N + V)), N being its count of all kept terms; what group p is
    from another q is floor((p - q)**2 / q). Part ``pair`` ranks all other sources of the language by the sum
    over all kept terms, 0 without any; part ``term`` the first ``top`` of the group's terms with p above the
    language's. Equal values are in UTF-8 order.

    A null text, lang or source counts as an empty one. Each row is a document, repeated ones too; a row
    without terms makes a group. A source alone in its language has no pairs. Other columns are ignored;
    an empty table gives no rows. Counts are exact up to 9 * 10**15.
    """
    counts = term_counts(docs, least)
    groups = _totals(docs, counts)
    near = source_distances(counts, groups).withColumnRenamed("other", "item")
    own = term_ranks(counts, groups, top).withColumnRenamed("term", "item")
    parts = [df.withColumn("part", F.lit(part)) for df, part in ((near, "pair"), (own, "term"))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources and terms of all documents."""
    return divergence(table(ready(spark), sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _p(count: str, total: str) -> str:
    return f"(1 + 1000000000::HUGEINT * ({count} + 1) // {total})"


SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS lang_c FROM words GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCS}),
counts AS (
  SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, sum(lang_c)::HUGEINT AS n, count(*) AS v FROM kept GROUP BY ALL),
sizes AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM counts GROUP BY ALL),
grp AS (
  SELECT d.lang, d.source, coalesce(v, 0) AS v, coalesce(l.n, 0) + coalesce(v, 0) AS lang_total,
    coalesce(s.n, 0) + coalesce(v, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN langs l USING (lang) LEFT JOIN sizes s USING (lang, source)),
dense AS (
  SELECT g.lang, g.source, k.term, {_p("coalesce(c, 0)", "g.total")} AS p
  FROM grp g JOIN kept k USING (lang) LEFT JOIN counts n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
shares AS (
  SELECT lang, source, term, {_p("c", "total")} AS p, {_p("lang_c", "lang_total")} AS q
  FROM counts JOIN kept USING (lang, term) JOIN grp USING (lang, source)),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
