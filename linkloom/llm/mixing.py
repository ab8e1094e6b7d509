"""Mixing sources to target weights by temperature.

Source shares of tokens are raised to an exponent and normalised. The exponent is bisected until the
weights meet a target entropy or a limit on repetition, and the weights are realised as passes over
each source, every pass a pseudo-random permutation of its documents, the last one cut at the
source's budget. Everything is DataFrame expressions; the driver sees a few sums for each halving.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.common import ready, table, written

WORD = r"[^ \t\n\r]+"
HALVINGS = 24
PREFIX = 4  # hex digits of a permutation key that make a range: at most 65536 ranges a source


@dataclass(frozen=True)
class Target:
    """``entropy``: least entropy of the weights, as a share of that of equal weights. ``repeats``: most
    passes over a source. ``budget``: tokens in all; without one, the fewest at which no source falls
    short of one pass, so that no document is left out. ``seed`` names the permutations."""

    entropy: float | None = None
    repeats: float | None = None
    budget: int | None = None
    seed: str = "mix"


def _sizes(docs: DataFrame) -> DataFrame:
    """``source, n`` tokens of each source, null being a source."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    return docs.groupBy("source").agg(F.sum(words).cast("long").alias("n"))


def _sums(sizes: DataFrame, power: float) -> dict:
    """Normaliser, entropy and passes at one exponent: sums over the sources, one row."""
    raised = F.pow(F.col("n").cast("double"), F.lit(power))
    log = F.log(F.col("n").cast("double")) * power
    row = sizes.agg(
        F.sum(raised).alias("total"),
        F.sum(raised * log).alias("weighted"),
        F.max(raised / F.col("n")).alias("most"),
        F.min(raised / F.col("n")).alias("least"),
        F.sum("n").alias("tokens"),
        F.count("*").alias("sources"),
    )
    # The sum of w ln w, with w = raised / total.
    return row.withColumn("entropy", F.log("total") - F.col("weighted") / F.col("total")).first().asDict()


def _budget(s: dict, target: Target) -> float:
    return float(target.budget) if target.budget else s["total"] / s["least"]


def exponent(sizes: DataFrame, target: Target) -> float:
    """The exponent between 0 (equal weights) and 1 (weights as found) that the target asks for.

    A limit on repetition needs an exponent large enough, a least entropy one small enough: the largest
    that keeps the entropy, or else the smallest within the limit, which goes first where both cannot be
    met. Without a target it is 1.
    """
    from math import log

    def low_enough(p: float) -> bool:
        s = _sums(sizes, p)
        return s["entropy"] >= target.entropy * log(s["sources"]) - 1e-12

    def high_enough(p: float) -> bool:
        s = _sums(sizes, p)
        return _budget(s, target) / s["total"] * s["most"] <= target.repeats

    def bisect(good, at_low: bool) -> float:
        low, high = 0.0, 1.0
        for _ in range(HALVINGS):
            middle = (low + high) / 2
            if good(middle) == at_low:
                low = middle
            else:
                high = middle
        return low if at_low else high

    chosen = 1.0
    if target.entropy is not None and not low_enough(1.0):
        chosen = bisect(low_enough, True)
    if target.repeats is not None and not high_enough(chosen):
        chosen = bisect(high_enough, False) if high_enough(1.0) else 1.0
    elif target.entropy is None and target.repeats is not None:
        chosen = 0.0 if high_enough(0.0) else bisect(high_enough, False)
    return chosen


def weights(docs: DataFrame, target: Target) -> DataFrame:
    """``source, n, weight, quota, passes, rest``: whole passes over each source and the tokens after.

    A source without a word has no weight and no say in those of others; it is passed once.
    """
    sizes = written(_sizes(docs), "sizes")
    with_words = sizes.filter("n > 0")
    power, s = 1.0, {"total": 1.0, "least": 1.0}
    if not with_words.isEmpty():
        power = exponent(with_words, target)
        s = _sums(with_words, power)
    raised = F.when(F.col("n") > 0, F.pow(F.col("n").cast("double"), F.lit(power))).otherwise(F.lit(0.0))
    out = sizes.withColumn("weight", raised / F.lit(s["total"]))
    out = out.withColumn("quota", F.round(F.col("weight") * F.lit(_budget(s, target))).cast("long"))
    whole = F.when(F.col("n") > 0, F.call_function("div", F.col("quota"), F.col("n"))).otherwise(F.lit(1))
    out = out.withColumn("passes", whole.cast("long"))
    return out.withColumn("rest", F.col("quota") - F.col("passes") * F.col("n"))


def _key(seed: str, turn: Column, doc: Column) -> Column:
    """Place of a document in the permutation of a pass."""
    name = F.coalesce(doc.cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), turn.cast("string"), name).cast("binary"))


def cuts(docs: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """``source, passes, edge``: the last key of the cut pass that is still within the budget.

    Keys are cut into ranges by prefix. Sums of the ranges before find the range in which the budget
    ends, and only its documents are put in order, so no task sorts a source.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    same = F.col("source").eqNullSafe(F.col("_source"))
    wanted = plan.filter("rest > 0").select(F.col("source").alias("_source"), "passes", "rest")
    last = docs.select("doc_id", "source", words.alias("tokens")).join(wanted, same).drop("_source")
    last = last.withColumn("key", _key(seed, F.col("passes") + 1, F.col("doc_id")))
    last = written(last.withColumn("range", F.substring("key", 1, PREFIX)), "last-pass")
    sums = last.groupBy("source", "passes", "rest", "range").agg(F.sum("tokens").alias("t"))
    upto = Window.partitionBy("source").orderBy("range")
    sums = sums.withColumn("before", F.sum("t").over(upto) - F.col("t"))
    open_range = sums.filter("before <= rest and before + t > rest")
    whole = sums.filter("before + t <= rest").groupBy("source").agg(F.max("range").alias("range"))
    # Equal keys are equal documents: they stay or go together.
    inside = (
        last.join(
            open_range.select(F.col("source").alias("_source"), F.col("range").alias("_range"), "before"),
            same & (F.col("range") == F.col("_range")),
        )
        .groupBy("source", "rest", "before", "key")
        .agg(F.sum("tokens").alias("tokens"))
    )
    run = F.sum("tokens").over(Window.partitionBy("source").orderBy("key"))
    edge = inside.withColumn("upto", F.col("before") + run).filter("upto <= rest")
    edges = edge.groupBy("source").agg(F.max("key").alias("edge"))
    # A range that fits whole ends above all of its keys.
    edges = edges.unionByName(whole.select("source", F.concat("range", F.lit("g")).alias("edge")))
    return edges.groupBy("source").agg(F.max("edge").alias("edge"))


def mixed(docs: DataFrame, target: Target) -> DataFrame:
    """``row, pass, place_key``: each row of ``docs`` (a struct of all its columns) once for each pass it
    is drawn in, from 1, and its order within that pass of its source.

    ``docs`` has ``doc_id, source, text``. A null source is a source; a null or empty text has no tokens
    and is drawn in every whole pass. A document whose tokens would pass the budget ends the cut pass.
    Repeated ids are drawn together. An empty table gives no rows. Texts are not shuffled where the
    table of sources is small enough to be broadcast by its measured size.
    """
    known = docs.select("doc_id", "source", "text")
    plan = written(weights(known, target), "weights")
    edges = cuts(known, plan, target.seed)
    named = edges.select(F.col("source").alias("of"), "edge")
    full = plan.join(named, plan["source"].eqNullSafe(named["of"]), "left")
    full = written(full.select(F.col("source").alias("of"), "passes", "edge"), "passes")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    drawn = rows.join(full, F.col("row.source").eqNullSafe(F.col("of")))
    doc = F.col("row.doc_id")
    every = F.when(F.col("passes") > 0, F.sequence(F.lit(1).cast("long"), F.col("passes")))
    last = F.col("passes") + 1
    extra = F.when(_key(target.seed, last, doc) <= F.col("edge"), F.array(last))
    none = F.array().cast("array<long>")
    turns = F.concat(F.coalesce(every, none), F.coalesce(extra, none))
    out = drawn.select("row", F.explode(turns).alias("pass"))
    return out.withColumn("place_key", _key(target.seed, F.col("pass"), doc))


#: The registered query: weights at least 0.97 of even, no source more than twice as often as another.
MIX = Target(entropy=0.97, repeats=2.5)


def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws of all documents: ``doc_id, source, pass, place_key``."""
    docs = table(ready(spark), sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs, MIX).select("row.doc_id", "row.source", "pass", "place_key")


def _at(power: str) -> tuple[str, str, str]:
    """Entropy, its target and the passes over the smallest source at an exponent, over the list ns."""
    total = f"list_sum(list_transform(ns, lambda n: pow(n, {power})))"
    weighted = f"list_sum(list_transform(ns, lambda n: pow(n, {power}) * ln(n) * {power}))"
    most = f"list_max(list_transform(ns, lambda n: pow(n, {power}) / n))"
    least = f"list_min(list_transform(ns, lambda n: pow(n, {power}) / n))"
    return f"ln({total}) - {weighted} / {total}", f"{MIX.entropy} * ln(len(ns)) - 1e-12", f"{most} / {least}"


def _sql() -> str:
    entropy, goal, passes = _at("(lo + hi) / 2")
    one_entropy, _, _ = _at("1.0")
    chosen_passes, one_passes = _at("chosen")[2], _at("1.0")[2]
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS tokens FROM documents),
sizes AS (SELECT source, sum(tokens)::DOUBLE AS n FROM docs GROUP BY source),
ns AS (SELECT list(n) AS ns FROM sizes WHERE n > 0),
low AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, ns FROM ns
  UNION ALL SELECT i + 1, CASE WHEN {entropy} >= {goal} THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN {entropy} >= {goal} THEN hi ELSE (lo + hi) / 2 END, ns FROM low WHERE i < {HALVINGS}),
first AS (SELECT CASE WHEN {one_entropy} >= {goal} THEN 1.0 ELSE lo END AS chosen, ns FROM low WHERE i = {HALVINGS}),
high AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, ns FROM ns
  UNION ALL SELECT i + 1, CASE WHEN {passes} <= {MIX.repeats} THEN lo ELSE (lo + hi) / 2 END,
    CASE WHEN {passes} <= {MIX.repeats} THEN (lo + hi) / 2 ELSE hi END, ns FROM high WHERE i < {HALVINGS}),
power AS (SELECT CASE WHEN {chosen_passes} <= {MIX.repeats} THEN chosen
    WHEN {one_passes} <= {MIX.repeats} THEN (SELECT hi FROM high WHERE i = {HALVINGS}) ELSE 1.0 END AS p, ns FROM first),
budget AS (SELECT p, list_sum(list_transform(ns, lambda n: pow(n, p))) AS total,
  list_min(list_transform(ns, lambda n: pow(n, p) / n)) AS least FROM power),
plan AS (SELECT source, n, CASE WHEN n > 0 THEN round(pow(n, p) / total * (total / least))::BIGINT ELSE 0 END AS quota
  FROM sizes, budget),
passes AS (SELECT source, CASE WHEN n > 0 THEN quota // n::BIGINT ELSE 1 END AS passes,
    CASE WHEN n > 0 THEN quota % n::BIGINT ELSE 0 END AS rest FROM plan),
keyed AS (SELECT doc_id, d.source, tokens, passes, rest,
    md5('{MIX.seed}:' || (passes + 1) || ':' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM docs d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source),
run AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY k) AS upto FROM keyed),
drawn AS (
  SELECT doc_id, source, unnest(range(1, passes + 1)) AS pass FROM keyed
  UNION ALL SELECT doc_id, source, passes + 1 FROM run WHERE rest > 0 AND upto <= rest)
SELECT doc_id, source, pass, md5('{MIX.seed}:' || pass || ':' || coalesce(doc_id::VARCHAR, '')) AS place_key FROM drawn
"""


SQL = _sql()
