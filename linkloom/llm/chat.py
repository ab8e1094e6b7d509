"""Reply trees as formatted conversations.

Messages point to the message they answer. Root-to-leaf paths are enumerated by self-joins on ids alone,
doubling the reach each time, so a tree of depth d takes about 2 log d joins; branches are ranked by score, and
each chosen path is formatted as one conversation whose control strings cannot occur in a text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.common import ready, saved, table

# The control strings of the template.
OPEN, NAMED, CLOSE = "<|", "|>\n", "</s>\n"
LEARNED = "assistant"
# Every control string, of this template and of those like it, begins with one of these.
_BEGIN = r"([<\[])"


def escaped(text: Column) -> Column:
    """A backslash after every character that can begin a control string; ``unescaped`` undoes it."""
    return F.regexp_replace(text, _BEGIN, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _BEGIN + r"\\", "$1")


def _escaped_role(role: Column) -> Column:
    return F.regexp_replace(role, r"([<\[|])", r"$1\\")


def _plain_role(role: Column) -> Column:
    return F.regexp_replace(role, r"([<\[|])\\", "$1")


def _doubled(parents: DataFrame, messages: int) -> tuple[list[DataFrame], DataFrame]:
    """``id, up``: ancestors 1, 2, 4, ... steps up, as long as somebody has one; and those who have one
    as far up as there are messages, so that their way leads into a circle."""
    steps = [parents]
    while True:
        last = steps[-1]
        higher = last.select(F.col("id").alias("up"), F.col("up").alias("higher"))
        further = saved(last.join(higher, "up").select("id", F.col("higher").alias("up")))
        if further.isEmpty() or 2 ** len(steps) >= messages:
            return steps, further.select("id")
        steps.append(further)


def paths(messages: DataFrame) -> DataFrame:
    """``leaf, id, height`` of every message on every root-to-leaf path; ``height`` is steps above the leaf.

    ``messages`` is ``id, parent``; a parent that is null or missing makes a root. A message whose
    parents lead into a circle has no root and no path.
    """
    known = saved(messages.select("id").distinct())
    up = messages.select("id", F.col("parent").alias("up")).filter("up is not null and up != id")
    up = saved(up.join(known.withColumnRenamed("id", "up"), "up", "left_semi").select("id", "up").distinct())
    steps, circling = _doubled(up, known.count())
    leaves = known.join(up.select(F.col("up").alias("id")), "id", "left_anti").join(circling, "id", "left_anti")
    out = leaves.select(F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("height"))
    # Heights are written in binary: every step is taken or not, largest first.
    for k, step in reversed(list(enumerate(steps))):
        out = saved(out)
        higher = out.join(step, "id").select("leaf", F.col("up").alias("id"), (F.col("height") + 2**k).alias("height"))
        out = out.unionByName(higher)
    return saved(out)


def chosen_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """``tree, branch, id, place``: the messages of the ``best`` branches of each tree, from the root.

    A branch scores the mean ``score`` of its messages (null counts as 0); ties go to the smaller leaf.
    ``tree`` is the column of that name.
    """
    found = paths(messages)
    scored = found.join(messages.select("id", "tree", F.coalesce("score", F.lit(0.0)).alias("score")), "id")
    branches = scored.groupBy("leaf").agg(
        F.min("tree").alias("tree"), F.avg("score").alias("score"), F.max("height").alias("top")
    )
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    kept = branches.withColumn("branch", rank).filter(F.col("branch") <= best)
    on = kept.select("tree", "branch", "leaf", "top").join(found, "leaf")
    return on.select("tree", "branch", "id", (F.col("top") - F.col("height")).alias("place"))


def formatted(turns: DataFrame, *key: str) -> DataFrame:
    """``key, formatted, loss``: one text for each conversation of ``turns(key, place, role, text)``.

    ``loss`` lists ``start`` (from 0) and ``length`` in code points of every assistant text in it. A
    null role or text is an empty one.
    """
    role = F.coalesce("role", F.lit(""))
    turn = F.struct(
        "place", role.alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text")
    )
    rows = turns.groupBy(*key).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    shown = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), _escaped_role(t["role"]), F.lit(NAMED)).alias("head"),
            t["text"].alias("text"),
            (t["role"] == LEARNED).alias("learned"),
        ),
    )
    rows = rows.select(*key, shown.alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(CLOSE))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def take(state: Column, t: Column) -> Column:
        begin, size = state["at"] + F.length(t["head"]), F.length(t["text"])
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct(
            (begin + size + len(CLOSE)).alias("at"),
            F.when(t["learned"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    loss = F.aggregate("turns", start, take, lambda s: s["spans"])
    return rows.select(*key, whole.alias("formatted"), loss.alias("loss"))


def parsed(text: Column) -> Column:
    """Turns ``role, text`` read back from a formatted conversation."""
    parts = F.slice(F.split(text, CLOSE, -1), 1, F.size(F.split(text, CLOSE, -1)) - 1)
    return F.transform(
        parts,
        lambda p: F.struct(
            _plain_role(F.substr(F.substring_index(p, NAMED, 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescaped(F.substr(p, F.length(F.substring_index(p, NAMED, 1)) + len(NAMED) + 1)).alias("text"),
        ),
    )


def under_loss(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    spans = F.transform(loss, lambda s: unescaped(F.substr(text, s["start"] + 1, s["length"])))
    return F.array_join(spans, "")


def as_messages(rows: DataFrame) -> DataFrame:
    """Conversations ``conv_id, turn, role, text`` as reply trees: each row answers the row before it.

    Rows follow each other by turn, then role and text, nulls first; equal rows are messages of their own.
    A null ``conv_id`` is a conversation too. Texts are not part of the ids.
    """
    kept = rows.select("conv_id", "turn", "role", "text").withColumn("id", F.monotonically_increasing_id())
    kept = saved(kept)
    own = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "id")
    return saved(kept.withColumn("parent", F.lag("id").over(own)))


def conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss``: every conversation of ``rows(conv_id, turn, role, text)``.

    Other columns are ignored; an empty table gives no rows.
    """
    messages = as_messages(rows)
    tree = messages.select("id", "parent", F.lit(0.0).alias("score"), F.struct("conv_id").alias("tree"))
    chosen = chosen_paths(tree).select("id", "place")
    turns = messages.join(chosen, "id").select("conv_id", "place", "role", "text")
    return formatted(turns, "conv_id")


def _probe(spark: SparkSession) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    return spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )


def op2_reply_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the formatted text."""
    ready(spark)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = conversations(rows.unionByName(_probe(spark)))
    out = out.select(
        "conv_id", "formatted", parsed(F.col("formatted")).alias("turns"),
        under_loss(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# A turn's text grows by one character for each < or [, a role for | as well.
SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(10 + length(regexp_replace(text, '[<\[]', '..', 'g')) + length(regexp_replace(role, '[<\[|]', '..', 'g')))::BIGINT
    AS formatted_chars
FROM c GROUP BY conv_id
"""
