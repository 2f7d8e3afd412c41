"""Document quality by a regularised quadratic discriminant.

Two Gaussian densities, one for each label, over transformed statistics of the whole
text. Their class sums and cross products are gathered by Spark over every labelled row
(nothing is sampled), so what reaches the driver is two matrices whatever the input.
Each class covariance is shrunk towards the pooled one and the pooled one towards its
diagonal; the Cholesky factors are computed once and shipped with the model. A score is
the logistic of the difference of the two log densities plus the log odds of the labels.

Defined results: null and empty texts have the statistics of an empty text and are
scored like any other; a null ``doc_id`` is never held out and never learned from;
labels other than 0 and 1 are ignored; repeated equal labels of a document count once,
a document with both labels is not learned from. With one class only, every score is the
share of that class; without labels every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.llm import text as tx

THRESHOLD = 0.3
HELD_OUT_MODULUS = 5
POOLED_WEIGHT = 0.1  # share of the pooled covariance in each class covariance
DIAGONAL_WEIGHT = 0.05  # share of its diagonal in the pooled covariance
FLOOR = 1e-3  # least variance of a statistic

STATISTICS = (
    "log_words",
    "word_chars",
    "symbols",
    "marks",
    "upper",
    "digits",
    "stops",
    "repeats",
    "variety",
    "repeated_lines",
    "bars",
    "exclaims",
)

# One class for each byte value.
_CLASSES = ("space", "continued", "letter", "upper", "digit", "bar", "symbol", "exclaim", "mark", "other")
_CLASS = np.full(256, _CLASSES.index("other"), np.uint8)
for _name, _bytes in (
    ("space", bytes(tx.SPACES)),
    ("continued", bytes(range(0x80, 0xC0))),
    ("letter", bytes(range(97, 123)) + bytes(range(0xC0, 0x100))),
    ("upper", bytes(range(65, 91))),
    ("digit", b"0123456789"),
    ("bar", b"|"),
    ("symbol", b"#*$%&<>{}[]=\\/^~_@+"),
    ("exclaim", b"!"),
    ("mark", b".,;:?'\"()-"),
):
    _CLASS[list(_bytes)] = _CLASSES.index(_name)
_END = np.frombuffer(b".!?", np.uint8)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text."""
    parts = [_chunk_statistics(c) for c in tx.chunks(column)]
    return np.vstack(parts) if parts else np.zeros((0, len(STATISTICS)))


def _chunk_statistics(chunk: tx.Chunk) -> np.ndarray:
    data, bounds = chunk.data, chunk.bounds
    at = tx.words(chunk)
    n_words = np.diff(at.of)
    some = np.maximum(n_words, 1)
    counts = tx.class_counts(_CLASS[data], bounds, len(_CLASSES))
    n = dict(zip(_CLASSES, counts.T, strict=True))
    solid = counts.sum(1) - n["space"] - n["continued"]
    letters = n["letter"] + n["upper"]
    prefix = tx.prefix_hashes(data)
    hashes = tx.span_hashes(prefix, at)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    heads = at.of[:-1][n_words > 0]
    again[heads] = False
    ended = np.isin(data[at.ends - 1], _END) if len(at.ends) else np.zeros(0, bool)
    lines = tx.spans(data != 10, bounds)
    n_lines = np.diff(lines.of)
    kinds = tx.distinct_per_text(hashes, at.of)
    share = lambda part, whole: np.sqrt(part / np.maximum(whole, 1))
    repeated_lines = n_lines - tx.distinct_per_text(tx.span_hashes(prefix, lines), lines.of)
    return np.column_stack(
        [
            np.log1p(n_words),
            np.log1p(solid / some),
            share(n["symbol"] + n["bar"], solid),
            share(n["mark"], solid),
            share(n["upper"], letters),
            share(n["digit"], solid),
            share(tx.totals(ended, at.of), n_words),
            share(tx.totals(again, at.of), n_words),
            # Herdan's index: distinct words as a power of all words
            np.log1p(kinds) / np.log1p(some),
            share(repeated_lines, n_lines),
            share(n["bar"], solid),
            share(n["exclaim"], solid),
        ]
    ).astype(np.float64)


@dataclass(frozen=True)
class Gaussian:
    """Mean, inverse Cholesky factor of the covariance, and the log density at the mean."""

    mean: np.ndarray
    factor: np.ndarray
    peak: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.factor.T
        return self.peak - 0.5 * np.einsum("ij,ij->i", z, z)


@dataclass(frozen=True)
class Model:
    """``classes`` is None if fewer than two labels were seen; then ``prior`` is every score."""

    prior: float
    classes: tuple[Gaussian, Gaussian] | None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.prior)
        bad, good = self.classes
        gap = good.log_density(x) - bad.log_density(x) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))


def from_moments(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Model:
    """The model from count, sum and cross-product matrix of each label."""
    seen = {k: m for k, m in moments.items() if m[0] > 0}
    total = sum(m[0] for m in seen.values())
    if len(seen) < 2:
        return Model(float(next(iter(seen), 0.5)), None)
    means = {k: s / n for k, (n, s, _) in seen.items()}
    scatter = {k: g - n * np.outer(means[k], means[k]) for k, (n, _, g) in seen.items()}
    pooled = sum(scatter.values()) / total
    spread = np.diag(np.maximum(np.diag(pooled), FLOOR))
    pooled = (1 - DIAGONAL_WEIGHT) * pooled + DIAGONAL_WEIGHT * spread
    fitted = []
    for k in (0, 1):
        cov = (1 - POOLED_WEIGHT) * scatter[k] / seen[k][0] + POOLED_WEIGHT * pooled
        low = np.linalg.cholesky(cov + FLOOR * np.eye(len(cov)))
        peak = -np.log(np.diag(low)).sum() - 0.5 * len(cov) * np.log(2 * np.pi)
        fitted.append(Gaussian(means[k], np.linalg.inv(low), float(peak)))
    return Model(seen[1][0] / total, (fitted[0], fitted[1]))


def held_out(doc_id: Column, modulus: int = HELD_OUT_MODULUS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == 0, F.lit(False))


def _moment_rows(batches):
    """Count, sum and cross products of each label in this task, as one row per label."""
    d = len(STATISTICS)
    sums = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for batch in batches:
        x = np.array(batch.column("x").flatten(), np.float64).reshape(-1, d)
        y = np.array(batch.column("y"))
        for k, into in sums.items():
            part = x[y == k]
            into += np.concatenate([[len(part)], part.sum(0), (part.T @ part).ravel()])
    keys = [k for k, v in sums.items() if v[0]]
    flat = pa.array([sums[k] for k in keys], pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), flat], ["y", "sums"])


def _statistic_rows(batches):
    for batch in batches:
        x = statistics(batch.column("text"))
        values = pa.array(x.ravel(), pa.float64())
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(x) + 1) * len(STATISTICS), pa.int32()), values
        )
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "x"])


def fit(documents: DataFrame, labels: DataFrame, modulus: int = HELD_OUT_MODULUS) -> Model:
    """Learn from all labelled documents that are not held out."""
    learn = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), modulus)
    )
    rated = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .where("y in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("most"))
        .where("y = most")
        .drop("most")
    )
    rows = learn.mapInArrow(_statistic_rows, "doc_id long, x array<double>").join(rated, "doc_id")
    per_task = rows.select("y", "x").mapInArrow(_moment_rows, "y int, sums array<double>")
    summed = (
        per_task.select("y", F.posexplode("sums").alias("i", "v"))
        .groupBy("y", "i")
        .agg(F.sum("v").alias("v"))
        .collect()  # two labels times the fixed number of moments
    )
    d = len(STATISTICS)
    flat = {y: np.zeros(1 + d + d * d) for y in {r.y for r in summed}}
    for r in summed:
        flat[r.y][r.i] = r.v
    return from_moments(
        {y: (v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d)) for y, v in flat.items()}
    )


def with_score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``documents`` and the score of each text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(statistics(texts)), pa.float64())

    return documents.withColumn(name, score(F.col("text")))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = fit(documents, labels)
    return with_score(documents.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
