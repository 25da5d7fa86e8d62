"""Quality classifier: naive Bayes support vectors.

A text is read as tokens (runs of letters, of digits, of one other sign) and as their shapes:
capitals, small letters, mixed, digits, the sign itself, and a mark where a
token repeats the one before. Its features are the *indicators* of the n-grams of both
readings (tokens of length 1 and 2, shapes of length 1 to 3), hashed into ``BUCKETS``
numbers, so that there is no vocabulary to cut. Every indicator is scaled by its class log-count
ratio ``log((p / |p|) / (q / |q|))``, ``p`` and ``q`` the add-one counts of training documents
of label 1 and label 0 with that feature. On these the linear hinge-loss model is
fitted by dual coordinate descent: one dual variable a document, which a closed-form step
keeps within ``[0, C]`` while the weights follow. A document's features are scaled to unit
length, so long texts don't weigh more. A logistic curve, fitted on margins
of training documents that were left out of the descent, turns margins into scores.

Fit. At most ``MAX_TRAIN`` labelled documents, and at most ``MAX_TRAIN_CHARS`` characters of
them, are used, those whose ids hash smallest (a bound on the fit only; every document is scored
on its whole text). Spark hashes their features and counts them by class; the
documents' distinct features (bounded by both, and ``BUCKETS`` a document) are the rows of the
descent on the driver. The model is one weight a bucket.

Cases: null labels, null texts and labels without a document are ignored in the fit; of several
labels of an id the largest counts, of several texts of an id the one of smallest md5; a null
doc_id is never a training row and is scored like any other; an empty or null text has the
bias alone; with no labelled rows, or of one class only, every score is the share of label 1
(one half without rows); repeated rows are scored alike; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import WordCache, held_out, labelled_sample, slices, stored

FOLDS, FOLD, THRESHOLD = 5, 0, 0.3
MAX_TRAIN, MAX_TRAIN_CHARS = 20_000, 100_000_000
BUCKETS, CACHE_TOKENS = 1 << 18, 200_000
PENALTY, EPOCHS, CALIBRATE = 1.0, 30, 5

_TOKEN = re.compile(r"[^\W\d_]+|\d+|([^\w\s]|_)\1*")
#: Odd multipliers that spread n-grams over the buckets.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def shape_of(token: str) -> str:
    if token[0].isalpha():
        return "A" if token.isupper() and len(token) > 1 else "a" if token.islower() else "Aa"
    return "0" if token[0].isdigit() else token[:2]


def _numbers(token: str) -> tuple[int, int]:
    """32-bit numbers of a token and of its shape."""
    return zlib.crc32(token.encode()), zlib.crc32(b"shape " + shape_of(token).encode())


REPEAT = zlib.crc32(b"shape =")


class Features:
    """Hashed n-gram indicators of texts; keeps the numbers of tokens met lately."""

    def __init__(self, buckets: int = BUCKETS):
        self.shift = np.uint64(64 - (buckets.bit_length() - 1))
        self.known = WordCache(_numbers, CACHE_TOKENS)

    def __call__(self, text: str) -> np.ndarray:
        """The sorted distinct bucket numbers of a text."""
        pairs = [self.known[m.group()] for m in _TOKEN.finditer(text)]
        if not pairs:
            return np.zeros(0, np.int64)
        token, shape = np.array(pairs, np.uint64).T
        shape = shape.copy()
        shape[1:][token[1:] == token[:-1]] = REPEAT
        grams = [self._grams(token, 1, 1), self._grams(token, 2, 2), self._grams(shape, 1, 3),
                 self._grams(shape, 2, 4), self._grams(shape, 3, 5)]
        return np.unique(np.concatenate(grams))

    def _grams(self, ids: np.ndarray, n: int, kind: int) -> np.ndarray:
        if len(ids) < n:
            return np.zeros(0, np.int64)
        h = np.full(len(ids) - n + 1, kind, np.uint64)
        for k in range(n):
            h = (h ^ ids[k:len(ids) - n + 1 + k]) * _MIX[k]
            h ^= h >> np.uint64(29)
        return (h * _MIX[0] >> self.shift).astype(np.int64)


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN,
                  max_chars: int = MAX_TRAIN_CHARS) -> DataFrame:
    """(doc_id, label, text, h) within both bounds; every id stands once."""
    marks = labels.select("doc_id", (F.col("quality") > 0).cast("int").alias("label"))
    return labelled_sample(docs, marks, FOLDS, FOLD, max_train, max_chars)


def bags(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(h, doc_id, label, features) of (doc_id, label, text, h)."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets)
        for batch in slices(batches, 256):
            found = [features(t).astype(np.int32) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(found, pa.list_(pa.int32()))],
                ["h", "doc_id", "label", "features"])

    return rows.select("h", "doc_id", "label", "text").mapInArrow(
        run, f"h long, doc_id {kind}, label int, features array<int>")


def log_count_ratios(bagged: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """One ratio a bucket; 0 for a bucket that no training document has."""
    counts = bagged.select("label", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q"))
    found = counts.toArrow()  # at most one row a bucket
    at = found.column("f").to_numpy()
    p, q = np.ones(len(at)) + found.column("p").to_numpy(), np.ones(len(at)) + found.column("q").to_numpy()
    ratios = np.zeros(buckets)
    ratios[at] = np.log(p / p.sum()) - np.log(q / q.sum())
    return ratios


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, penalty: float = PENALTY,
                 epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights of the indicators and the bias: minimises ``|w|^2 / 2 + C * sum of
    max(0, 1 - y w.x)`` over unit-length rows ``x`` of scaled indicators and a constant. The
    classes share ``C`` evenly, so the rarer one isn't lost. ``y`` is 1 or -1."""
    weight = np.zeros(len(ratios))
    bias = 0.0
    share = {s: len(y) / (2 * max(1, (y == s).sum())) for s in (-1, 1)}
    most = np.array([penalty * share[s] for s in y])
    values = [scaled(r, ratios).astype(np.float32) for r in rows]
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            f, x = rows[i], values[i]
            slope = y[i] * (weight[f] @ x + bias) - 1  # rows have length one, and the constant one
            new = min(max(alpha[i] - slope / 2, 0.0), most[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                weight[f] += step * x
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weight, bias


def scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    x = ratios[row]
    return x / max(1e-12, np.sqrt(x @ x))


def logistic(margins: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(slope, shift) of P(label 1 | margin), by Newton steps on smoothed targets."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)])
    theta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -40, 40)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x @ (target - p) - 1e-6 * theta)
        theta = theta + step / max(1.0, np.abs(step).max())
    return float(theta[0]), float(theta[1])


class Model:
    """Margins and scores of texts; with a ``prior`` every text gets that score."""

    def __init__(self, ratios: np.ndarray, weight: np.ndarray, bias: float, slope: float,
                 shift: float, prior: float | None = None):
        self.ratios, self.weight = ratios.astype(np.float32), weight.astype(np.float32)
        self.bias, self.slope, self.shift, self.prior = bias, slope, shift, prior
        self._features = None

    def __getstate__(self):
        return self.__dict__ | {"_features": None}

    def margin(self, text: str) -> float:
        if self._features is None:
            self._features = Features(len(self.weight))
        row = self._features(text)
        return float(self.weight[row] @ scaled(row, self.ratios)) + self.bias

    def score(self, text: str) -> float:
        if self.prior is not None:
            return self.prior
        z = self.slope * self.margin(text) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def train(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, penalty: float = PENALTY,
          epochs: int = EPOCHS, **bounds) -> Model:
    bagged = stored(bags(training_rows(docs, labels, **bounds), buckets), "quality-bags")
    sizes = bagged.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("good")).first()
    zeros = np.zeros(buckets)
    if not 0 < sizes["good"] < sizes["n"]:
        prior = sizes["good"] / sizes["n"] if sizes["n"] else 0.5
        return Model(zeros, zeros, 0.0, 0.0, 0.0, prior)
    ratios = log_count_ratios(bagged, buckets)
    table = bagged.orderBy("h", "doc_id").select("label", "features").toArrow()  # within both bounds
    y = np.where(table.column("label").to_numpy() > 0, 1, -1)
    flat = table.column("features").combine_chunks()
    ends = flat.offsets.to_numpy()
    rows = [flat.values.to_numpy()[a:b] for a, b in zip(ends, ends[1:])]  # views, not copies
    left_out = np.arange(len(y)) % CALIBRATE == 0
    if len(set(y[~left_out])) < 2 or len(set(y[left_out])) < 2:
        left_out[:] = False  # too few rows to leave some out: the curve is fitted on all
    fit = np.flatnonzero(~left_out)
    weight, bias = dual_descent([rows[i] for i in fit], y[fit], ratios, penalty, epochs)
    test = np.flatnonzero(left_out) if left_out.any() else fit
    margins = np.array([weight[rows[i]] @ scaled(rows[i], ratios) + bias for i in test])
    return Model(ratios, weight, bias, *logistic(margins, y[test]))


def score_column(text: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return score(F.coalesce(text.cast("string"), F.lit("")))


def quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score and predicted."""
    model = train(docs, labels, **settings)
    return docs.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
        score_column(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
