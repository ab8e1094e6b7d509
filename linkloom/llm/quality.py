"""Document quality by regularised quadratic discriminant analysis.

Statistics of a text are transformed to be near normal within a class; each class has a mean and a
covariance shrunk towards the pooled one and towards a sphere. A score is the logistic of the
difference of the two log densities, from Mahalanobis distances under Cholesky factors that are
computed once and travel with the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.common import ready, table, text_pieces, texts, written
from linkloom.llm.words import shingle_sets, word_codes, word_spans

_KINDS = {
    "upper": np.arange(65, 91),
    "lower": np.arange(97, 123),
    "digit": np.arange(48, 58),
    "high": np.arange(128, 256),
    "stop": np.frombuffer(b".?;:", np.uint8),
    "comma": np.frombuffer(b",", np.uint8),
    "shout": np.frombuffer(b"!", np.uint8),
    "bar": np.frombuffer(b"|", np.uint8),
    "sign": np.frombuffer(b"#$%&*+/<=>@[\\]^_`{}~", np.uint8),
    "line": np.frombuffer(b"\n", np.uint8),
}
STATISTICS = (
    "words", "word_length", "length_spread", "long_words", "upper", "digit", "high", "stop", "comma",
    "shout", "bar", "sign", "line", "same_as_last", "vocabulary", "repeated_runs",
)
RUN = 4  # words of a run for ``repeated_runs``
SHRINK = 0.1  # share of the pooled covariance in each class's
SPHERE = 1e-3  # share of a sphere of the same mean variance
CUT = 0.7  # least score of a document that is kept
# Log odds per unit of log-density difference: normal densities overstate how sure they are.
SLOPE = 0.25


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return np.diff(sums[offsets])


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of transformed statistics for each text; zeros and constants for one without words."""
    starts, ends, firsts = word_spans(data, offsets)
    codes = word_codes(data, starts, ends)
    n = np.diff(firsts)
    some = np.maximum(n, 1)
    sizes = (ends - starts).astype(float)
    size_sum = _per_text(sizes, firsts)
    mean = size_sum / some
    spread = np.sqrt(np.maximum(_per_text(sizes**2, firsts) / some - mean**2, 0))
    size = np.maximum(size_sum, 1)
    table = np.zeros((len(_KINDS), 256), bool)
    for k, members in enumerate(_KINDS.values()):
        table[k, members] = True
    kinds = {name: _per_text(table[k][data], offsets) for k, name in enumerate(_KINDS)}
    letters = np.maximum(kinds["upper"] + kinds["lower"] + kinds["high"], 1)
    again = np.r_[False, codes[1:] == codes[:-1]] if len(codes) else np.zeros(0, bool)
    again[firsts[:-1][n > 0]] = False
    vocabulary = np.diff(shingle_sets(codes, firsts, 1)[1])
    runs = np.diff(shingle_sets(codes, firsts, RUN)[1])
    possible = np.maximum(n - RUN + 1, 1)
    root = np.sqrt
    return np.column_stack(
        [
            np.log1p(n),
            np.log1p(mean),
            np.log1p(spread),
            root(_per_text(sizes > 14, firsts) / some),
            root(kinds["upper"] / letters),
            root(kinds["digit"] / size),
            root(kinds["high"] / size),
            root(kinds["stop"] / some),
            root(kinds["comma"] / some),
            root(kinds["shout"] / some),
            root(kinds["bar"] / some),
            root(kinds["sign"] / some),
            root(kinds["line"] / some),
            root(_per_text(again, firsts) / some),
            np.log1p(vocabulary) / np.log1p(some),
            root(np.maximum(possible - runs, 0) / possible),
        ]
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, statistics`` of every row, from the whole text and nothing else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_pieces(batches):
            rows = pa.array(list(statistics(data, offsets)), pa.list_(pa.float64()))
            yield pa.record_batch([part.column("doc_id"), rows], names=["doc_id", "statistics"])

    return texts(docs).mapInArrow(run, "doc_id long, statistics array<double>")


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors of both classes; ``constant`` is the score without them."""

    means: np.ndarray | None
    whiten: np.ndarray | None
    logdet: np.ndarray | None
    prior: float
    constant: float = 0.5
    slope: float = SLOPE

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.constant)
        density = []
        for mean, whiten, logdet in zip(self.means, self.whiten, self.logdet):
            z = (x - mean) @ whiten.T
            density.append(-0.5 * np.einsum("nd,nd->n", z, z) - logdet)
        odds = self.slope * (density[1] - density[0]) + self.prior
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fitted(labelled: DataFrame, shrink: float = SHRINK, sphere: float = SPHERE) -> Discriminant:
    """A discriminant from ``labelled(statistics, label)``, all of its rows.

    Only the sums, products and counts of the two classes reach the driver. With fewer than two rows
    of a class there are no densities, and every score is the share of label 1 (0.5 without labels).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(STATISTICS)
        count, total, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in batches:
            if batch.num_rows:
                x = batch.column("statistics").flatten().to_numpy().reshape(-1, d)
                y = batch.column("label").to_numpy()
                for c in (0, 1):
                    own = x[y == c]
                    count[c] += len(own)
                    total[c] += own.sum(axis=0)
                    products[c] += own.T @ own
        sums = [np.concatenate([[count[c]], total[c], products[c].ravel()]) for c in (0, 1)]
        columns = [pa.array([0, 1], pa.int32()), pa.array(sums, pa.list_(pa.float64()))]
        yield pa.record_batch(columns, names=["label", "sums"])

    parts = labelled.select("statistics", "label").mapInArrow(run, "label int, sums array<double>")
    rows = parts.select("label", F.posexplode("sums").alias("i", "v")).groupBy("label", "i")
    d = len(STATISTICS)
    sums = np.zeros((2, 1 + d + d * d))
    for label, i, v in rows.agg(F.sum("v")).collect():  # twice 1 + d + d * d numbers
        sums[label, i] = v
    count = sums[:, 0]
    if count.min() < 2:
        share = float(count[1] / count.sum()) if count.sum() else 0.5
        return Discriminant(None, None, None, 0.0, share)
    means = sums[:, 1 : 1 + d] / count[:, None]
    scatter = sums[:, 1 + d :].reshape(2, d, d) - count[:, None, None] * np.einsum(
        "cd,ce->cde", means, means
    )
    pooled = scatter.sum(axis=0) / count.sum()
    whiten, logdet = [], []
    for c in (0, 1):
        cov = (1 - shrink) * scatter[c] / count[c] + shrink * pooled
        cov = (1 - sphere) * cov + sphere * max(np.trace(pooled) / d, 1e-9) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(factor))
        logdet.append(np.log(np.diag(factor)).sum())
    prior = float(np.log(count[1] / count[0]))
    return Discriminant(means, np.array(whiten), np.array(logdet), prior)


def learned(known: DataFrame, labels: DataFrame) -> Discriminant:
    """Fitted on the labelled rows of ``known(doc_id, statistics)`` that are not held out."""
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    marks = marks.filter(F.col("label").isin(0, 1) & ~held_out())
    return fitted(known.join(marks, "doc_id"))


def held_out():
    """Rows that no model may learn from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def quality_scores(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs(doc_id, text)``.

    ``labels(doc_id, quality)`` may cover any part of the rows; other values than 0 and 1 teach nothing.
    The score is between 0 and 1, higher where label 1 is likelier, and is a function of the text
    alone; null and empty texts get the score of their (constant) statistics. Repeated and null ids
    are scored row by row, a null id is not held out; other columns are ignored; an empty table
    gives no rows.
    """
    known = written(document_statistics(docs), "statistics")
    model = learned(known, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("statistics").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array(model.scores(x))], names=["doc_id", "score"]
                )

    scored = known.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """Rows of ``docs`` that score at least ``cut``, all their columns kept; texts are not shuffled."""
    # Written first: where the labels are broadcast, statistics and sums would be two Python steps of
    # one task, and executors keep a worker for each as long as the session is busy.
    model = learned(written(document_statistics(docs), "statistics"), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_pieces(batches):
            keep = model.scores(statistics(data, offsets)) >= cut
            yield part.filter(pa.array(keep))

    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    return docs.mapInArrow(run, nullable)


def op3_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels."""
    ready(spark)
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
