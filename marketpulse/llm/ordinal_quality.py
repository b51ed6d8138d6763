"""Quality as an ordinal grade: cumulative-link regression on hashed text features.

Grades 0 < 1 < ... < K-1 share one weight vector over hashed features and differ by ordered thresholds:
P(grade <= k) = sigmoid(t[k] - w.x) (McCullagh, 1980). A document gets the expected grade and the probability of a grade
of at least `least`, by which it is selected.

Features come from the whole text: every blank-separated token as its lower-cased letters and as its shape, averaged over
the tokens, and a few bands (length, share of distinct tokens, equal lines, symbols). Neither ids nor other columns count.

The model is fitted on a bounded sample of labelled rows (SAMPLE_ROWS, SAMPLE_BYTES) that leaves out the held-out third
and passes over texts that do not fit it. Spark computes the sample's features and scores all documents in one pass without a shuffle. Null and empty texts have
only their length band. Without labels the weights stay 0 and the start thresholds select every document; labels of which no
document is there are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, functions as F

from marketpulse.llm.common import keyed_schema, labelled_sample, training_labels

DIMENSIONS = 1 << 16
SAMPLE_ROWS, SAMPLE_BYTES = 6000, 48 << 20
CACHED = 400_000
# Weight of the averaged tokens against the bands.
TOKEN_SCALE = 10.0
ROUNDS, RATE, RIDGE = 150, 0.05, 1e-4


def feature_index(feature: str) -> int:
    from zlib import crc32

    return crc32(feature.encode()) % DIMENSIONS


def token_features(token: str) -> tuple[int, int]:
    """Hashed features of a token: its lower-cased letters and digits, and its shape."""
    core = "".join(c for c in token if c.isalnum()).lower()
    shape, last = [], ""
    for c in token:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if kind != last:
            shape.append(kind)
        last = kind
    return feature_index("w " + core), feature_index("s " + "".join(shape))


def bands(text: str, tokens: list[str]) -> list[int]:
    """Hashed features of the whole text, one of each family."""
    n = len(tokens)
    if not n:
        return [feature_index("length 0")]
    lines = [line for line in text.split("\n") if line.strip()]
    symbols = sum(map(text.count, "#*$%&|<>"))
    letters = sum(map(len, tokens))
    return [
        feature_index(f"length {n.bit_length()}"),
        feature_index(f"distinct {10 * len(set(tokens)) // n} {n.bit_length() // 2}"),
        feature_index(f"lines {10 * len(set(lines)) // len(lines)}"),
        feature_index(f"symbols {min(9, 50 * symbols // letters)}"),
        feature_index(f"letters {min(20, letters // n)}"),
    ]


def reader() -> Callable[[str], tuple[list[int], list[float]]]:
    """Features of a text as (indices, values); the features of tokens are kept, up to a bound."""
    from collections import Counter

    cache: dict[str, tuple[int, int]] = {}

    def read(text: str) -> tuple[list[int], list[float]]:
        if len(cache) > CACHED:
            cache.clear()
        tokens = text.split()
        values: dict[int, float] = {}
        for token, n in Counter(tokens).items():
            both = cache.get(token)
            if both is None:
                both = cache[token] = token_features(token)
            for i in both:
                values[i] = values.get(i, 0.0) + TOKEN_SCALE * n / len(tokens)
        for i in bands(text, tokens):
            values[i] = values.get(i, 0.0) + 1.0
        return list(values), list(values.values())

    return read


@dataclass(frozen=True)
class OrdinalModel:
    """Weights and ordered thresholds."""

    weights: Any
    thresholds: Any

    def grades(self, score):
        """(probability of each grade, one row for each score)."""
        import numpy as np

        below = 1.0 / (1.0 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))
        edges = np.hstack([np.zeros((len(score), 1)), below, np.ones((len(score), 1))])
        return np.maximum(np.diff(edges, axis=1), 0.0)


def fit(rows, indices, values, grades, n_grades: int) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on the whole sample. Gaps between thresholds are kept as logarithms."""
    import numpy as np

    weights = np.zeros(DIMENSIONS)
    start = np.linspace(-1.0, 1.0, n_grades - 1) if n_grades > 2 else np.array([-1.0])
    free = np.concatenate([start[:1], np.log(np.diff(start))])
    n = len(grades)
    if not n:
        return OrdinalModel(weights, start)
    params = np.concatenate([weights, free])
    first, second = np.zeros_like(params), np.zeros_like(params)

    def ordered(free):
        return np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])

    def sigmoid(z):
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))

    at = np.arange(n)
    for t in range(1, ROUNDS + 1):
        weights, free = params[:DIMENSIONS], params[DIMENSIONS:]
        score = np.bincount(rows, weights=values * weights[indices], minlength=n)
        edges = ordered(free)
        cdf = np.hstack([np.zeros((n, 1)), sigmoid(edges[None, :] - score[:, None]), np.ones((n, 1))])
        slope = cdf * (1 - cdf)
        p = np.maximum(cdf[at, grades + 1] - cdf[at, grades], 1e-12)
        # Of the mean log-likelihood: by the score, and by each threshold.
        by_score = -(slope[at, grades + 1] - slope[at, grades]) / p / n
        by_edge = np.zeros(n_grades + 1)
        np.add.at(by_edge, grades + 1, slope[at, grades + 1] / p / n)
        np.add.at(by_edge, grades, -slope[at, grades] / p / n)
        by_edge = by_edge[1:-1]
        by_free = np.concatenate([[by_edge.sum()], np.cumsum(by_edge[::-1])[::-1][1:] * np.exp(free[1:])])
        by_weight = np.bincount(indices, weights=values * by_score[rows], minlength=DIMENSIONS) - RIDGE * weights
        gradient = np.concatenate([by_weight, by_free])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params = params + RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return OrdinalModel(params[:DIMENSIONS], ordered(params[DIMENSIONS:]))


def train(
    docs: DataFrame, labels: DataFrame, grade: str, n_grades: int, key: str = "doc_id", text: str = "text",
    sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES,
) -> OrdinalModel:
    """Fit on a sample of `docs`; `grade` is an SQL expression over the labels' columns, from 0 to n_grades - 1."""
    import numpy as np

    def featurise(batches: Iterable) -> Iterator:
        import pyarrow as pa

        read = reader()
        for batch in batches:
            found = [read(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float32()))],
                names=["label", "indices", "values"],
            )

    sample = labelled_sample(docs, labels, F.expr(grade).cast("int"), sample_rows, sample_bytes, key, text)
    got = sample.mapInArrow(featurise, "label int, indices array<int>, values array<float>").toArrow()
    if not len(got) and not training_labels(labels, F.expr(grade), key).isEmpty() and not docs.isEmpty():
        raise ValueError("there are labels, but no labelled document to learn from")
    lengths = np.array(got["indices"].combine_chunks().value_lengths(), dtype=np.int64)
    return fit(
        np.repeat(np.arange(len(lengths)), lengths), np.asarray(got["indices"].combine_chunks().flatten()),
        np.asarray(got["values"].combine_chunks().flatten(), dtype=np.float64),
        np.clip(np.asarray(got["label"], dtype=np.int64), 0, n_grades - 1), n_grades,
    )


def score(docs: DataFrame, model: OrdinalModel, least: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, expected_grade, tail): the mean grade and the probability of a grade of at least `least`."""
    # Plain values: broadcasts are read back by name, and the workers may not have this library.
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def judge(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        model = OrdinalModel(*shared.value)
        weights = model.weights
        cache: dict[str, float] = {}

        def of_text(text: str) -> float:
            if len(cache) > CACHED:
                cache.clear()
            tokens = text.split()
            scores = list(map(cache.get, tokens))
            if None in scores:
                for token in set(tokens):
                    if token not in cache:
                        a, b = token_features(token)
                        cache[token] = float(weights[a] + weights[b])
                scores = [cache[token] for token in tokens]
            mean = TOKEN_SCALE * sum(scores) / len(tokens) if tokens else 0.0
            return mean + float(sum(weights[i] for i in bands(text, tokens)))

        for batch in batches:
            p = model.grades(np.array([of_text(t.as_py() or "") for t in batch.column(1)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p @ np.arange(p.shape[1])), pa.array(p[:, least:].sum(axis=1))],
                names=[key, "expected_grade", "tail"],
            )

    return docs.select(key, text).mapInArrow(judge, keyed_schema(docs, key, "expected_grade double, tail double"))
