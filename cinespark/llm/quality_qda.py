"""Operator 8, quality score by a regularised quadratic discriminant.

Every text becomes FEATURES transformed statistics (logarithms of sizes, square roots of shares). Each class
has a mean and a covariance shrunk towards its scaled identity by SHRINK; a score is the posterior of label 1
from the difference of the two log densities, with Mahalanobis distances from Cholesky factors that are
computed once and sent to the tasks. All labelled training rows are used: they reach the driver as sums of
features and of their products, one row a class.

Defined results: null and empty texts have the statistics of no word; without rows of one class the score
is 1 or 0 for the other, without any label 0.5; labels of unknown doc_ids, null labels and null doc_ids are
not learnt from; repeated rows count each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.llm.common import SOLID, joined, shards, span_hashes, stored, table, utf8_list, word_spans
from cinespark.llm.langid import held_out

FEATURES = ("log_words", "word_length", "upper", "digit", "symbol", "punctuation", "exclamation", "bar", "distinct",
            "distinct_threes", "distinct_lines", "line_words", "follows_itself", "non_ascii")
SHRINK = 0.1
FLOOR = 1e-3              # least variance of a transformed statistic
ACCEPT = 0.7


def _kinds() -> np.ndarray:
    k = np.zeros((256, 6), bool)
    k[65:91, 0] = True
    k[48:58, 1] = True
    k[[35, 36, 37, 38, 42, 60, 62, 64, 94, 95, 126, 92, 61, 43], 2] = True
    k[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63], 3] = True
    k[33, 4] = True
    k[124, 5] = True
    return k


_KINDS = _kinds()


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of transformed statistics for each text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for a, b in shards(texts, 1 << 20):
        buf, offsets = joined(texts[a:b])
        n = b - a
        size = np.maximum(np.diff(offsets) - 1, 1)
        starts, ends = word_spans(buf, SOLID)
        doc = np.searchsorted(offsets, starts, "right") - 1
        words = np.bincount(doc, minlength=n)
        some = np.maximum(words, 1)
        length = np.bincount(doc, ends - starts, minlength=n)
        share = lambda mask: np.add.reduceat(mask, offsets[:-1]).astype(float)

        def distinct(h, d):
            by = np.lexsort((h, d))
            h, d = h[by], d[by]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            return np.bincount(d[new], minlength=n) / np.maximum(np.bincount(d, minlength=n), 1)

        h = span_hashes(buf, starts, ends)
        same = doc[2:] == doc[:-2] if len(doc) > 2 else np.zeros(0, bool)
        with np.errstate(over="ignore"):
            threes = (h[:-2] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[2:] * np.uint64(7))[same] if len(doc) > 2 else h[:0]
        line_start, line_end = word_spans(buf, np.arange(256) != 10)
        line_doc = np.searchsorted(offsets, line_start, "right") - 1
        lines = np.bincount(line_doc, minlength=n)
        twice = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]) if len(h) > 1 else np.zeros(0, bool)
        f = out[a:b]
        f[:, 0] = np.log1p(words)
        f[:, 1] = np.log1p(length / some)
        for k, kind in enumerate(_KINDS.T):
            f[:, 2 + k] = np.sqrt(share(kind[buf]) / size)
        f[:, 8] = distinct(h, doc)
        f[:, 9] = distinct(threes, doc[:-2][same]) if len(doc) > 2 else 0
        f[:, 10] = distinct(span_hashes(buf, line_start, line_end), line_doc)
        f[:, 11] = np.log1p(words / np.maximum(lines, 1))
        f[:, 12] = np.sqrt(np.bincount(doc[1:][twice], minlength=n) / some) if len(h) > 1 else 0
        f[:, 13] = np.sqrt(share(buf >= 128) / size)
    return out


def _measure(column: pa.Array) -> pa.Array:
    rows = statistics(utf8_list(column))
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, len(FEATURES), dtype=np.int32), pa.array(rows.ravel()))


class Discriminant:
    """Mean, inverse Cholesky factor, log determinant and log prior of each class."""

    def __init__(self, sums: dict[int, tuple[int, np.ndarray, np.ndarray]]):
        total = sum(n for n, _, _ in sums.values())
        self.classes = {}
        for label, (n, s, products) in sums.items():
            mean = s / n
            cov = products / n - np.outer(mean, mean)
            target = np.diag(np.maximum(np.diag(cov), FLOOR))
            cov = (1 - SHRINK) * cov + SHRINK * target
            cov[np.diag_indices(len(mean))] += FLOOR
            factor = np.linalg.cholesky(cov)
            self.classes[label] = mean, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(), np.log(n / total)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Posterior of label 1."""
        density = {}
        for label, (mean, inverse, log_det, prior) in self.classes.items():
            z = (rows - mean) @ inverse.T
            density[label] = prior - 0.5 * (log_det + (z * z).sum(1))
        if len(density) < 2:
            return np.full(len(rows), float(next(iter(density), 0.5)))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(measured: DataFrame) -> Discriminant:
    """From rows (features, label 0 or 1)."""
    size = len(FEATURES)
    f = F.col("features")
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    rows = measured.groupBy("label").agg(
        F.count("*").alias("n"), F.array(*(F.sum(f[i]) for i in range(size))).alias("s"),
        F.array(*(F.sum(f[i] * f[j]) for i, j in pairs)).alias("p")).collect()
    sums = {}
    for r in rows:
        products = np.zeros((size, size))
        for (i, j), v in zip(pairs, r.p):
            products[i, j] = products[j, i] = v
        sums[int(r.label)] = r.n, np.array(r.s), products
    return Discriminant(sums)


def measure(docs: DataFrame, out: str = "features") -> DataFrame:
    if out in docs.columns:
        raise ValueError(f"the column name {out!r} is taken")
    return docs.withColumn(out, F.arrow_udf(_measure, "array<double>")(F.col("text")))


def score(measured: DataFrame, model: Discriminant, out: str = "score") -> DataFrame:
    sent = measured.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> pa.Array:
        rows = column.flatten().to_numpy().reshape(-1, len(FEATURES))
        return pa.array(sent.value.score(rows), pa.float64())
    return measured.withColumn(out, F.arrow_udf(run, "double")(F.col("features")))


def op8_quadratic(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(measure(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "features"))
    labels = table(spark, sf_dir, "labels").filter("quality in (0, 1)").select("doc_id", F.col("quality").alias("label"))
    model = fit(measured.filter(~held_out()).join(labels, "doc_id").select("features", "label"))
    return score(measured, model).select("doc_id", held_out().alias("held_out"), "score",
                                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
