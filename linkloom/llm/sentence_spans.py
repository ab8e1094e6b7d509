"""Repeated passages by sliding sentence spans.

Every run of ``SPAN`` consecutive sentences is hashed, equal runs are joined over the whole corpus, and
sentences covered by a run that is not the first of its kind are repeated. All of it is DataFrame
expressions; what is shuffled is one narrow row per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.common import ready, saved, table, texts

SPAN = 2
LONG = 40  # words; a sentence this long is a run by itself
LEAST = 20  # words of a stretch of repeated sentences that the registered query reports
_BLANK = " \t\r\n"
# A sentence ends after a stop and white space, or at a line end.
BREAK = r"[.!?][ \t\r\n]+|\n[ \t\r\n]*"
PIECE = rf"(?s).*?(?:{BREAK})|.+"
WORD = r"[^ \t\r\n]+"


def pieces(text: Column) -> Column:
    """Sentences with the white space after them; joined they are the text (but for leading blanks)."""
    parts = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    return F.filter(parts, lambda s: F.btrim(s, F.lit(_BLANK)) != "")


def _runs(docs: DataFrame) -> DataFrame:
    """``doc_id, at, words, next_words, key_a, key_b`` of every run; ``next_words`` is null for one
    long sentence."""
    bare = F.transform(pieces(F.col("text")), lambda s: F.btrim(s, F.lit(_BLANK)))
    rows = texts(docs).select("doc_id", bare.alias("s")).filter("doc_id is not null and size(s) > 0")
    zipped = F.transform("s", lambda this, i: F.struct(this.alias("this"), F.get("s", i + 1).alias("v")))
    one = rows.select("doc_id", F.posexplode(zipped).alias("at", "c")).select("doc_id", "at", "c.*")
    words = F.regexp_count("this", F.lit(WORD))
    pair = F.when(F.col("v").isNotNull(), F.struct("v"))
    alone = F.when(words >= LONG, F.struct(F.lit(None).cast("string").alias("v")))
    both = F.explode(F.array_compact(F.array(pair, alone)))
    rows = one.select("doc_id", "at", "this", words.alias("words"), both.alias("next"))
    follows = F.col("next.v")
    return rows.select(
        "doc_id",
        "at",
        "words",
        F.regexp_count(follows, F.lit(WORD)).alias("next_words"),
        F.xxhash64("this", follows).alias("key_a"),
        F.xxhash64(follows, F.lit(1), "this").alias("key_b"),
    )


def repeated_sentences(docs: DataFrame, least: int = 0) -> DataFrame:
    """``doc_id, sentence_no, first_doc_id, first_sentence_no, stretch_words`` of every repeated sentence.

    Sentences of ``docs(doc_id, text)`` are numbered from 0; two are equal when they are to the letter,
    white space around them aside. A sentence is repeated when it lies in a run of two sentences (or is
    a sentence of 40 words or more) that occurs earlier, by ``doc_id`` and number, in the same or another
    document; the first place named is the smallest of those its runs point to. ``stretch_words`` counts
    the words of the unbroken stretch of repeated sentences that it lies in; with ``least``, shorter
    stretches are left alone. Null and empty texts have no sentences; rows with a
    null id take no part, rows with one id are the same document; other columns are ignored; an empty
    table gives no rows.
    """
    runs = _runs(docs)
    place = F.struct("doc_id", "at")
    key = ["key_a", "key_b"]
    again = runs.groupBy(*key).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    again = saved(again.filter("first != last").drop("last"))
    hits = runs.join(again, key).filter(place != F.col("first"))
    first = F.col("first")
    covered = hits.select(
        "doc_id",
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.col("at").alias("n"), F.col("words").alias("w"), first.alias("f")),
                    F.when(
                        F.col("next_words").isNotNull(),
                        F.struct(
                            (F.col("at") + 1).alias("n"),
                            F.col("next_words").alias("w"),
                            F.struct(first["doc_id"].alias("doc_id"), (first["at"] + 1).alias("at")).alias("f"),
                        ),
                    ),
                )
            )
        ).alias("c"),
    )
    one = covered.groupBy("doc_id", F.col("c.n").alias("n")).agg(
        F.max("c.w").alias("w"), F.min("c.f").alias("f")
    )
    own = Window.partitionBy("doc_id").orderBy("n")
    stretch = one.withColumn("stretch", F.col("n") - F.row_number().over(own))
    whole = Window.partitionBy("doc_id", "stretch")
    return (
        stretch.withColumn("words", F.sum("w").over(whole))
        .filter(F.col("words") >= least)
        .select(
            "doc_id",
            F.col("n").alias("sentence_no"),
            F.col("f.doc_id").alias("first_doc_id"),
            F.col("f.at").alias("first_sentence_no"),
            F.col("words").cast("long").alias("stretch_words"),
        )
    )


def without_sentences(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` less the sentences ``repeated(doc_id, sentence_no)``, all columns kept.

    Rows stay even where nothing of the text does; texts that lose nothing stay as they are.
    """
    gone = repeated.groupBy("doc_id").agg(F.collect_set("sentence_no").alias("gone"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    joined = rows.join(gone, F.col("row.doc_id") == F.col("doc_id"), "left")
    own = F.col("row.text")
    kept = F.filter(pieces(own), lambda s, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNotNull(), F.array_join(kept, "")).otherwise(own)
    return joined.select(
        *[(text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]
    )


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated sentence of the documents in a stretch of 20 words or more, with the place it repeats.

    Shorter stretches are stock phrases that documents share by chance; the operator reports them as well.
    """
    return repeated_sentences(table(ready(spark), sf_dir, "documents"), LEAST)


SQL = rf"""
WITH cut AS (
  SELECT doc_id, list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '{PIECE}'),
    lambda s: trim(s, ' ' || chr(9) || chr(13) || chr(10))), lambda s: s <> '') AS s
  FROM documents WHERE doc_id IS NOT NULL),
sent AS (
  SELECT doc_id, unnest(range(len(s))) AS n, unnest(s) AS this, s FROM cut),
counted AS (
  SELECT doc_id, n, this, s[n + 2] AS follows, len(regexp_extract_all(this, '{WORD}')) AS w FROM sent),
runs AS (
  SELECT doc_id, n, w, this, follows, len(regexp_extract_all(follows, '{WORD}')) AS w2 FROM counted
  WHERE follows IS NOT NULL
  UNION ALL SELECT doc_id, n, w, this, NULL, NULL FROM counted WHERE w >= {LONG}),
placed AS (
  SELECT *, min((doc_id, n)) OVER (PARTITION BY this, follows) AS f FROM runs),
hits AS (SELECT * FROM placed WHERE (doc_id, n) <> f),
covered AS (
  SELECT doc_id, n, w, f[1] AS fd, f[2] AS fn FROM hits
  UNION ALL SELECT doc_id, n + 1, w2, f[1], f[2] + 1 FROM hits WHERE follows IS NOT NULL),
one AS (SELECT doc_id, n, max(w) AS w, min((fd, fn)) AS f FROM covered GROUP BY ALL),
stretches AS (
  SELECT *, n - row_number() OVER (PARTITION BY doc_id ORDER BY n) AS stretch FROM one),
summed AS (SELECT *, sum(w) OVER (PARTITION BY doc_id, stretch) AS words FROM stretches)
SELECT doc_id, n AS sentence_no, f[1] AS first_doc_id, f[2] AS first_sentence_no,
  words::BIGINT AS stretch_words
FROM summed WHERE words >= {LEAST}
"""
