"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a vector of statistics (shares of characters, words, lines), transformed to be less skewed.
For each label the mean and the covariance of the vectors are estimated; the covariance is shrunk towards
the one that both labels share, and that towards its diagonal, so it can be inverted whatever the statistics.
A score is the difference of two log densities (Mahalanobis distances by the Cholesky factors, which are
computed once) and of the log priors, as a probability.

Estimates come from sums over all labelled rows given (one row a label reaches the driver), so nothing is
sampled. Texts are read once and not shuffled; only vectors are joined with labels.

Defined results: NULL is taken as an empty text, whose statistics are zeros, and scored like any other. Without rows
of both labels the score is the share of label 1, or 0.5 without any. Repeated rows are scored each by
itself, and count as often as they occur when fitting. Extra columns are left out; ids are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Shares by which a label's covariance moves to the common one, and that to its diagonal.
TO_COMMON, TO_DIAGONAL = 0.1, 0.05
# Log densities are divided by this: statistics of one text agree more than their covariance says.
TEMPERATURE = 2.0
ROWS = 1_000

FEATURES = (
    "log_chars", "log_words", "upper", "lower", "digits", "marks", "symbols", "spaces", "breaks", "word_length",
    "distinct_words", "same_as_before", "most_frequent", "distinct_lines", "marked_words",
)

# Kinds of characters; the rest, such as ideographs, is a letter without case.
_OTHER, _UPPER, _LOWER, _DIGIT, _MARK, _SYMBOL, _SPACE, _BREAK = range(8)


def _kinds() -> np.ndarray:
    kinds = np.zeros(0x110000, np.uint8)
    for code in range(0x20000):
        c = chr(code)
        if c == "\n":
            kinds[code] = _BREAK
        elif c.isspace():
            kinds[code] = _SPACE
        elif c.isupper():
            kinds[code] = _UPPER
        elif c.islower():
            kinds[code] = _LOWER
        elif c.isdigit():
            kinds[code] = _DIGIT
        elif c in ".,;:!?'\"()-":
            kinds[code] = _MARK
        elif not c.isalnum():
            kinds[code] = _SYMBOL
    return kinds


_TABLE: list[np.ndarray] = []


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    if not _TABLE:
        _TABLE.append(_kinds())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(codes)
    kinds = np.bincount(_TABLE[0][codes], minlength=8)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    many = max(len(words), 1)
    same = sum(map(str.__eq__, words, words[1:]))
    marked = sum(not word[-1].isalnum() for word in words)
    share = kinds / n
    return [
        np.log1p(n),
        np.log1p(len(words)),
        np.sqrt(share[_UPPER]),
        np.sqrt(share[_LOWER]),
        np.sqrt(share[_DIGIT]),
        np.sqrt(share[_MARK]),
        np.sqrt(share[_SYMBOL]),
        np.sqrt(share[_SPACE]),
        np.sqrt(share[_BREAK]),
        np.log1p((n - kinds[_SPACE] - kinds[_BREAK]) / many),
        len(counts) / many,
        np.sqrt(same / many),
        np.sqrt(max(counts.values(), default=0) / many),
        len(set(lines)) / max(len(lines), 1),
        np.sqrt(marked / many),
    ]


def measured(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, x): the vector of each row."""
    source = df.select(id_column, text)
    schema = T.StructType([source.schema[0], T.StructField("x", T.ArrayType(T.DoubleType()))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                vectors = [statistics(body.as_py() or "") for body in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(vectors, pa.list_(pa.float64()))], names=names)

    return source.mapInArrow(run, schema)


class Gaussian(NamedTuple):
    mean: np.ndarray
    whiten: np.ndarray  # inverse of the Cholesky factor
    offset: float  # log prior less half the log determinant


class Model(NamedTuple):
    labels: tuple[Gaussian, Gaussian] | None
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 of the rows of ``x``."""
        if self.labels is None:
            return np.full(len(x), self.share)
        bad, good = (g.offset - 0.5 * (((x - g.mean) @ g.whiten.T) ** 2).sum(axis=1) / TEMPERATURE for g in self.labels)
        return 1.0 / (1.0 + np.exp(np.clip(bad - good, -700, 700)))


def fit(vectors: DataFrame, label: str = "quality", vector: str = "x") -> Model:
    """Estimate from all rows of (label 0 or 1, vector); a label is summed up in one row."""
    size = len(FEATURES)
    at = [F.get(vector, F.lit(i)) for i in range(size)]
    firsts = [F.sum(at[i]).alias(f"s{i}") for i in range(size)]
    seconds = [F.sum(at[i] * at[j]).alias(f"s{i}_{j}") for i in range(size) for j in range(i + 1)]
    found = {}
    for row in vectors.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count("*").alias("n"), *firsts, *seconds).collect():
        n = row["n"]
        mean = np.array([row[f"s{i}"] for i in range(size)]) / n
        square = np.zeros((size, size))
        for i in range(size):
            for j in range(i + 1):
                square[i, j] = square[j, i] = row[f"s{i}_{j}"] / n
        found[row[label]] = (n, mean, square - np.outer(mean, mean))
    rows = sum(n for n, _, _ in found.values())
    share = found[1][0] / rows if 1 in found else (0.0 if found else 0.5)
    if len(found) < 2:
        return Model(None, share)
    common = sum(n * covariance for n, _, covariance in found.values()) / rows
    # The least variance of a statistic that never changes keeps the matrix regular.
    spread = np.diag(np.maximum(np.diag(common), 1e-6))
    common = (1 - TO_DIAGONAL) * common + TO_DIAGONAL * spread
    gaussians = []
    for value in (0, 1):
        n, mean, covariance = found[value]
        lower = np.linalg.cholesky((1 - TO_COMMON) * covariance + TO_COMMON * common)
        log_det = 2 * np.log(np.diag(lower)).sum()
        gaussians.append(Gaussian(mean, np.linalg.inv(lower), np.log(n / rows) - 0.5 * log_det / TEMPERATURE))
    return Model(tuple(gaussians), share)


def scored(vectors: DataFrame, model: Model, into: str = "score", vector: str = "x") -> DataFrame:
    """Add the score of each vector; the model, two small matrices, goes with the tasks."""
    at = vectors.columns.index(vector)
    schema = T.StructType([*vectors.schema, T.StructField(into, T.DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(at).flatten()).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], names=names)

    return vectors.mapInArrow(run, schema)
