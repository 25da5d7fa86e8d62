"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has the probability
``sigmoid(bias + sum of the weights of its distinct words)``, where a word's weight is
that of the word itself plus those of its prefixes of 4 to 8 letters; a document is toxic
unless every sentence is clean, so its probability is the noisy-or
``1 - prod(1 - p)``. The weights are trained from document labels alone, and the
trained sentence scores then locate the offending sentences.

Fit. At most ``MAX_TRAIN`` labelled documents, and at most ``MAX_TRAIN_CHARS`` characters of
them, those whose ids hash smallest, are used (bounds on the fit only; every document is scored on its
whole text). Spark counts in how many
toxic and clean training documents each word and prefix stands; the ``VOCABULARY`` of them
with the strongest log-odds are the features. The bags go to the driver as flat arrays of
feature numbers (bounded by the parameters), where gradient steps with an L2 penalty fit
the weights.

Sentences end at ``.``, ``!``, ``?`` or a line end that white space or the text's
end follows. Words are runs of letters, lower-cased. Score: empty and null texts have no
sentence and score 0.

Cases: null labels and labels without a document are ignored; of several labels of an
id the largest counts, of several texts the one of smallest md5; a null doc_id is never a training row and is scored like any
other; repeated rows are scored alike; with no labelled rows, or of one class only, the
score is the share of toxic training rows; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import held_out, labelled_sample, slices, stored

FOLDS, FOLD = 5, 0
MAX_TRAIN, MAX_TRAIN_CHARS, VOCABULARY, MIN_DOCS = 20_000, 100_000_000, 4096, 3
PREFIXES = range(4, 9)
CACHE_WORDS = 200_000
L2, STEPS, RATE = 3e-5, 400, 0.05

_END = re.compile(r"(?<=[.!?\n])\s+|\n+")
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


class _WordWeights(dict):
    """Weights of the words met so far (at most ``CACHE_WORDS``, then it starts anew)."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        get = self.weights.get
        value = self[word] = sum(get(f, 0.0) for f in features_of(word))
        return value


class Model:
    """Feature ``weights`` and the sentence ``bias``; with a ``prior`` every text that has
    a sentence gets that score."""

    def __init__(self, weights: dict[str, float], bias: float, prior: float | None = None):
        self.weights, self.bias, self.prior = weights, bias, prior
        self._words = _WordWeights(weights)

    def __reduce__(self):
        return Model, (self.weights, self.bias, self.prior)

    def _logits(self, sentences: list[str]) -> np.ndarray:
        weight = self._words.__getitem__
        return self.bias + np.array([sum(map(weight, set(_WORD.findall(s)))) for s in sentences])

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of each sentence; offsets in code points."""
        cuts = [(0, 0), *((m.start(), m.end()) for m in _END.finditer(text)), (len(text), len(text))]
        spans = [(a[1], b[0]) for a, b in zip(cuts, cuts[1:]) if text[a[1]:b[0]].strip()]
        if not spans:
            return []
        z = self._logits([text[a:b].lower() for a, b in spans])
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return [(a, b, x) for (a, b), x in zip(spans, p.tolist())]

    def score(self, text: str) -> float:
        """Noisy-or of the sentence probabilities."""
        parts = [s for s in _END.split(text.lower()) if s and not s.isspace()]
        if not parts:
            return 0.0
        if self.prior is not None:
            return self.prior
        return float(-np.expm1(-np.logaddexp(0.0, self._logits(parts)).sum()))


def bags(docs: DataFrame, vocabulary: dict[str, int] | None) -> DataFrame:
    """Labelled documents to rows: without a vocabulary (label, word) for each distinct feature;
    with one the bag: label, number of sentences without a feature, and for each other
    sentence its features."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            label, word = [], []
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {f for w in set(_WORD.findall(text.lower())) for f in features_of(w)}
                word += found
                label += [y] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(word)],
                                             ["label", "word"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in slices(batches, 256):
            plain, known = [], []
            for text in batch.column(1).to_pylist():
                rows = [sorted(i for w in set(_WORD.findall(s)) for f in features_of(w)
                               if (i := get(f)) is not None)
                        for s in _END.split(text.lower()) if s.strip()]
                known.append([r for r in rows if r])
                plain.append(len(rows) - len(known[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(plain, pa.int32()),
                 pa.array(known, pa.list_(pa.list_(pa.int32()))), *batch.columns[2:]],
                ["label", "plain", "known", "h", "doc_id"])

    if vocabulary is None:
        return docs.select("label", "text").mapInArrow(words, "label int, word string")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("label", "text", "h", "doc_id").mapInArrow(
        features, f"label int, plain int, known array<array<int>>, h long, doc_id {kind}")


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN,
                  max_chars: int = MAX_TRAIN_CHARS) -> DataFrame:
    """(doc_id, label, text, h) of the training documents, each id once."""
    marks = labels.select("doc_id", (F.col("toxic") > 0).cast("int").alias("label"))
    return labelled_sample(docs, marks, FOLDS, FOLD, max_train, max_chars)


class Bags:
    """Labels ``y``, sentences without a feature ``plain``, and for each feature of a sentence its
    number ``feature`` and the sentence ``sentence``, which is one of the document ``doc``."""

    def __init__(self, table: pa.Table):
        self.y = table.column("label").to_numpy().astype(float)
        self.plain = table.column("plain").to_numpy().astype(float)
        known = table.column("known").combine_chunks()
        per_doc, inner = np.diff(known.offsets.to_numpy()), known.values
        self.doc = np.repeat(np.arange(len(self.y)), per_doc)
        sizes = np.diff(inner.offsets.to_numpy())
        self.sentence = np.repeat(np.arange(len(sizes)), sizes)
        self.feature = inner.values.to_numpy().astype(np.int64)


def loss_and_gradient(bags: Bags, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood of the noisy-or plus L2 on the weights; ``theta`` ends with
    the bias."""
    w, b = theta[:-1], theta[-1]
    n, soft = len(bags.doc), lambda z: np.logaddexp(0.0, z)
    z = b + np.bincount(bags.sentence, w[bags.feature], n) if n else np.zeros(0)
    s = np.bincount(bags.doc, soft(z), len(bags.y)) + bags.plain * soft(b)  # -log of P(all clean)
    s = np.maximum(s, 1e-9)
    toxic = bags.y > 0
    loss = np.where(toxic, -np.log(-np.expm1(-np.minimum(s, 50))), s).mean() + L2 * (w @ w)
    g = np.where(toxic, -1 / np.expm1(np.minimum(s, 50)), 1.0) / len(bags.y)  # d loss / d s
    gz = g[bags.doc] / (1 + np.exp(-z))
    grad = np.empty_like(theta)
    grad[:-1] = np.bincount(bags.feature, gz[bags.sentence], len(w)) + 2 * L2 * w
    grad[-1] = gz.sum() + (g * bags.plain).sum() / (1 + np.exp(-b))
    return float(loss), grad


def _fit(bags: Bags, n_words: int) -> tuple[np.ndarray, float]:
    """Adam steps on ``loss_and_gradient``."""
    theta = np.zeros(n_words + 1)
    theta[-1] = -6.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        grad = loss_and_gradient(bags, theta)[1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        theta = theta - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, vocabulary: int = VOCABULARY, **bounds) -> Model:
    rows = stored(training_rows(docs, labels, **bounds), "train-rows")
    sizes = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    if not 0 < sizes["toxic"] < sizes["n"]:
        return Model({}, 0.0, sizes["toxic"] / max(1, sizes["n"]))
    toxic, clean = sizes["toxic"], sizes["n"] - sizes["toxic"]
    counts = bags(rows, None).groupBy("word").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic - F.col("t") + 0.5)) - F.log(
        (F.col("c") + 0.5) / (clean - F.col("c") + 0.5))
    spread = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = counts.where(F.col("t") + F.col("c") >= MIN_DOCS).orderBy(
        F.abs(odds / spread).desc(), "word").limit(vocabulary)
    numbers = {r["word"]: i for i, r in enumerate(best.select("word").collect())}
    w, b = _fit(Bags(bags(rows, numbers).orderBy("h", "doc_id").toArrow()), len(numbers))
    return Model({x: float(w[i]) for x, i in numbers.items() if abs(w[i]) > 1e-3}, b)


def score_column(text: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return score(F.coalesce(text.cast("string"), F.lit("")))


def offending_column(text: Column, model: Model) -> Column:
    """The spans of the sentences with a probability of one half or more."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    @F.arrow_udf(T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType())])))
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([[{"start": a, "end": b, "score": p} for a, b, p in model.sentences(t.as_py())
                          if p >= 0.5] for t in texts], kind)

    return spans(F.coalesce(text.cast("string"), F.lit("")))


def toxicity(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted and
    ``offending`` (spans of offending sentences; empty unless predicted)."""
    model = train(docs, labels, **bounds)
    scored = docs.select("doc_id", "text", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
                         score_column(F.col("text"), model).alias("score"))
    flagged = F.when(F.col("score") >= 0.5, F.col("text"))
    return scored.select("doc_id", "held_out", "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         offending_column(flagged, model).alias("offending"))


def keep_clean(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    model = train(docs, labels, **bounds)
    return docs.where(score_column(F.col("text"), model) < 0.5)
