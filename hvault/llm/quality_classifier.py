"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each document becomes a vector of statistics of its whole text (lengths,
character classes, repetition), transformed towards normal shape. Per class, a
mean and a covariance are taken over all labelled training rows (two
aggregates over the statistics; no sampling). A class covariance is shrunk
towards the pooled one and then towards the diagonal, so it stays invertible.
A score is the logistic of the classes' Mahalanobis log-density difference,
computed with Cholesky factors that are made once and kept with the model.

Defined results: null text is empty; empty texts have statistics and a score
like others; a null doc_id is scored and is not held out. Without labelled
rows of both classes every score is 0.5 (predicted 1, so nothing is
rejected). Labels that are null are not used; rows of ``labels`` that repeat
count each. Columns besides those named are ignored; lang, source, doc_id and
labels are no inputs of a score.
"""

from __future__ import annotations

import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm.common import stored

NAMES = ("words", "word_length", "distinct", "upper", "digit", "mark", "odd", "shout", "lines", "common", "repeat", "short", "ends", "accent")
TO_POOLED = 0.5  # weight of the pooled covariance in a class covariance
TO_DIAGONAL = 0.1  # weight of the diagonal after that
FOLDS, HELD = 3, 1

#: Byte classes: rows of a table with one column per byte.
CLASSES = np.zeros((6, 256))
CLASSES[0, ord("A") : ord("Z") + 1] = 1
CLASSES[1, ord("0") : ord("9") + 1] = 1
CLASSES[2, [ord(c) for c in ".,;:'\"()-?"]] = 1
CLASSES[3, [i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,;:'\"()-?!"]] = 1
CLASSES[4, ord("!")] = 1
CLASSES[5, 0x80:0xC0] = 1  # continuation bytes of other letters


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of one text, in the order of NAMES."""
    words = text.split()
    n, size = len(words), len(text)
    upper, digit, mark, odd, shout, accent = CLASSES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256) if size else (0,) * 6
    letters = sum(map(len, words))
    # pseudo-counts keep the shares of very short texts near those of others
    share = lambda x, of: np.log((x + 1.0) / (of + 30.0))
    counts = Counter(words)
    common = max(counts.values()) if n else 0
    repeat = sum(map(operator.eq, words, words[1:]))
    short = sum(v for w, v in counts.items() if len(w) <= 3)
    ends = sum(v for w, v in counts.items() if w[-1:] in b".?!")
    return [
        np.log1p(n),
        np.log((letters + 5.0) / (n + 1.0)),
        np.log((len(counts) + 1.0) / (n + 1.0)),
        share(upper, size),
        share(digit, size),
        share(mark, size),
        share(odd, size),
        share(shout, size),
        share(text.count(b"\n"), n),
        share(common, n),
        share(repeat, n),
        share(short, n),
        share(ends, n),
        share(accent, size),
    ]


def document_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of every document."""

    def run(it):
        for batch in it:
            x = [statistics(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    """Scale of the statistics and, per class, log prior, mean and inverse Cholesky factor with its log determinant."""

    centre: np.ndarray
    scale: np.ndarray
    classes: list

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, priors included, per row of statistics."""
        if len(self.classes) < 2:
            return np.zeros(len(x))
        z = (x - self.centre) / self.scale
        parts = []
        for log_prior, mean, inverse, log_det in self.classes:
            d = (z - mean) @ inverse.T
            parts.append(log_prior - log_det - 0.5 * np.einsum("ij,ij->i", d, d))
        return parts[1] - parts[0]


def fit(rows: DataFrame, to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL) -> Model:
    """Model from rows (x, quality): class sizes, sums and products by two aggregates over all rows."""
    k = len(NAMES)
    col = lambda i: F.col("x")[i]
    overall = rows.agg(*[F.avg(col(i)).alias(f"m{i}") for i in range(k)], *[F.stddev_pop(col(i)).alias(f"s{i}") for i in range(k)]).first()
    centre = np.array([overall[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([overall[f"s{i}"] or 1.0 for i in range(k)])
    z = rows.select("quality", *[((col(i) - float(centre[i])) / float(scale[i])).alias(f"z{i}") for i in range(k)])
    sums = [F.sum(f"z{i}").alias(f"a{i}") for i in range(k)] + [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)]
    by = {r["quality"]: r for r in z.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), *sums).collect()}
    if set(by) != {0, 1}:
        return Model(centre, scale, [])
    total = sum(r["n"] for r in by.values())
    stats, pooled = [], np.zeros((k, k))
    for c in (0, 1):
        r, n = by[c], by[c]["n"]
        mean = np.array([r[f"a{i}"] for i in range(k)]) / n
        cov = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                cov[i, j] = cov[j, i] = r[f"p{i}_{j}"] / n - mean[i] * mean[j]
        stats.append((n, mean, cov))
        pooled += cov * n / total
    classes = []
    for n, mean, cov in stats:
        cov = (1 - to_pooled) * cov + to_pooled * pooled
        cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(cov) + 0.1)
        factor = np.linalg.cholesky(cov)
        classes.append((float(np.log(n / total)), mean, np.linalg.inv(factor), float(np.log(np.diag(factor)).sum())))
    return Model(centre, scale, classes)


def held_out(doc_id):
    """The fold that is kept from training: crc32 of the id as text modulo 3 is 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS)) == HELD, F.lit(False))


def trained(stats: DataFrame, labels: DataFrame) -> Model:
    train = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & ~held_out("doc_id"))
    return fit(stats.join(train, "doc_id"))


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (probability of class 1), predicted of every document."""
    stats = stored(document_statistics(documents), "statistics")
    model = trained(stats, labels)

    def run(it):
        for batch in it:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(NAMES))
            score = 1 / (1 + np.exp(-np.clip(model.log_odds(x), -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose text is predicted 1, with their columns."""
    model = trained(stored(document_statistics(documents), "statistics"), labels)
    names = documents.columns

    def run(it):
        for batch in it:
            x = np.array([statistics((t.as_py() or "").encode()) for t in batch.column(batch.schema.get_field_index("text"))]).reshape(-1, len(NAMES))
            yield batch.filter(pa.array(model.log_odds(x) >= 0))

    return documents.mapInArrow(run, documents.schema).select(*names)
