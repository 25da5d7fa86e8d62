"""Language identification of mixed-language texts.

A word (a letter and the letters and marks that follow it, lower-cased) has a score for each learned language: the
log probability of its character n-grams (1 to 4, with marks at both ends) in that
language's training text. Its script narrows the candidates to the languages that were
seen in that script. The Viterbi path over the words, where each change of language
costs ``SWITCH``, labels spans of one language; the text's language is the one with
the most words, and its score is their share.

Fit. At most ``MAX_TRAIN`` documents with a language outside the held-out fold, and at most
``MAX_TRAIN_CHARS`` characters of them, those whose ids hash smallest, are counted by Spark, and the ``GRAMS``
commonest n-grams and the ``LANGUAGES`` languages of most training documents are kept (bounds on the fit
only; every text is labelled whole).

Cases: ``und`` with score 0 for a null text, one without letters, or when nothing was
learned; null languages and null ids don't train; ties go to the language that sorts
first; of several texts or languages of an id one trains (smallest md5, largest language); null
and repeated ids and repeated rows keep their rows; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import held_out, labelled_sample, slices, stored

FOLDS, FOLD = 4, 2
MAX_TRAIN, MAX_TRAIN_CHARS, GRAMS, LANGUAGES = 20_000, 100_000_000, 50_000, 256
ORDERS, ALPHA = (1, 2, 3, 4), 0.5
SWITCH, OTHER_SCRIPT, SCRIPT_SHARE = 8.0, 30.0, 0.001
CACHE_WORDS, FLUSH, UNKNOWN = 300_000, 200_000, "und"
#: First code points of script blocks, and the script from there on.
SCRIPTS = ((0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"),
           (0x590, "hebrew"), (0x600, "arabic"), (0x900, "devanagari"), (0x980, "indic"),
           (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
           (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
           (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
           (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
           (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han"))
_STARTS = [s for s, _ in SCRIPTS]


@cache
def word_pattern() -> re.Pattern:
    """A letter (Unicode category L) and the letters and marks (M) after it, as ``re`` ranges: vowel
    signs belong to their word, while raised digits, fractions and Roman numerals are no letters."""
    def ranges(kinds: str) -> str:
        inside = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] in kinds]
        out, first = [], inside[0]
        for a, b in zip(inside, [*inside[1:], -1]):
            if b != a + 1:
                out.append(f"\\U{first:08x}-\\U{a:08x}")
                first = b
        return "".join(out)

    return re.compile(f"[{ranges('L')}][{ranges('LM')}]*")


#: Below U+0300 and without raised digits and fractions there are no marks, and every \w that
#: is neither a digit nor ``_`` is a letter: the quick pattern does.
_RICH = re.compile("[²³¹¼-¾̀-\U0010ffff]")
_QUICK = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    low = text.lower()
    return (word_pattern() if _RICH.search(low) else _QUICK).findall(low)


def script_of(word: str) -> str:
    return SCRIPTS[max(0, bisect_right(_STARTS, ord(word[0])) - 1)][1]


def grams_of(word: str) -> list[str]:
    w = f"<{word}>"
    return [w[i:i + n] for n in ORDERS for i in range(len(w) - n + 1)]


class Model:
    """Learned languages and the score of each n-gram in each of them: ``scores`` has a
    row for each of ``grams`` and a last one for n-grams that weren't kept."""

    def __init__(self, languages: list[str], grams: list[str], scores: np.ndarray,
                 scripts: dict[str, np.ndarray]):
        self.languages, self.grams, self.scores, self.scripts = languages, grams, scores, scripts
        self.number = {g: i for i, g in enumerate(grams)}
        self.known: dict[str, bytes] = {}  # scores of words met lately

    def __reduce__(self):
        return Model, (self.languages, self.grams, self.scores, self.scripts)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row of scores for each of ``words`` (all different)."""
        get, last = self.number.get, len(self.grams)
        rows = [[get(g, last) for g in grams_of(w)] for w in words]
        sizes = np.array([len(r) for r in rows])
        flat = np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum()))
        total = np.add.reduceat(self.scores[flat], np.cumsum(sizes) - sizes)
        # the n-grams overlap: one part a letter
        total *= ((np.array([len(w) for w in words]) + 1) / sizes)[:, None]
        script = [script_of(w) for w in words]
        for name, allowed in self.scripts.items():
            if not allowed.all():
                at = np.flatnonzero([s == name for s in script])
                barred = total[at].min(axis=1, keepdims=True) - OTHER_SCRIPT
                total[at] = np.where(allowed, total[at], barred)
        return total.astype(np.float32)

    def _learn(self, words: list[str]) -> None:
        """Puts the scores of ``words`` into ``known``, which holds them and others up to a bound."""
        new = sorted(set(words).difference(self.known))
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known = {}
            new = sorted(set(words))
        for at in range(0, len(new), 8192):
            part = new[at:at + 8192]
            raw, size = self.word_scores(part).tobytes(), 4 * len(self.languages)
            for i, w in enumerate(part):
                self.known[w] = raw[i * size:(i + 1) * size]

    def label(self, texts: list[str]) -> list[np.ndarray]:
        """The language number of every word of every text."""
        words = [words_of(t) for t in texts]
        size = np.array([len(w) for w in words], np.int64)
        flat = list(chain.from_iterable(words))
        self._learn(flat)
        scores = np.frombuffer(b"".join(map(self.known.__getitem__, flat)), np.float32)
        return viterbi(scores.reshape(-1, len(self.languages)), size)


def viterbi(scores: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Best paths of several texts at once: ``scores`` (words, languages) of texts of
    ``size`` words, one after the other; a change of language costs ``SWITCH``."""
    order = np.argsort(-size, kind="stable")
    start = (np.cumsum(size) - size)[order]
    longest = size[order]
    alive = np.searchsorted(-longest, -np.arange(1, int(longest.max(initial=0)) + 1), "right")
    state = np.zeros((len(size), scores.shape[1]), np.float64)
    best = np.zeros(len(scores), np.int16)  # language before a change into this word
    switch = np.zeros(scores.shape, bool)
    for t, k in enumerate(alive):
        at, s = start[:k] + t, state[:k]
        if t:
            top = s.argmax(axis=1)
            most = s[np.arange(k), top][:, None] - SWITCH
            best[at] = top
            switch[at] = s < most
            s = np.maximum(s, most)
        s = s + scores[at]
        state[:k] = s - s.max(axis=1, keepdims=True)
    path = np.zeros(len(scores), np.int16)
    now = state.argmax(axis=1)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        at = start[:k] + t
        path[at] = now[:k]
        if t:
            now[:k] = np.where(switch[at, now[:k]], best[at], now[:k])
    return np.split(path, np.cumsum(size)[:-1]) if len(size) else []


def training_rows(docs: DataFrame, max_train: int = MAX_TRAIN, max_chars: int = MAX_TRAIN_CHARS) -> DataFrame:
    marks = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("lang").cast("string").alias("label"))
    rows = stored(labelled_sample(docs, marks, FOLDS, FOLD, max_train, max_chars), "train-rows")
    named = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(LANGUAGES).select("label")
    return rows.join(F.broadcast(named), "label").select(F.col("label").alias("lang"), "text")


def train(docs: DataFrame, max_train: int = MAX_TRAIN, n_grams: int = GRAMS) -> Model:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            counts: Counter = Counter()
            for (lang, word), n in found.items():
                counts[lang, True, script_of(word)] += n
                for g in grams_of(word):
                    counts[lang, False, g] += n
            found.clear()
            lang, script, gram = zip(*counts) if counts else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(script, pa.bool_()), pa.array(gram, pa.string()),
                 pa.array(counts.values(), pa.int64())], ["lang", "script", "gram", "n"])

        for batch in slices(batches, 128):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update((lang, w) for w in words_of(text))
                if len(found) >= FLUSH:
                    yield out()
        yield out()

    counts = stored(training_rows(docs, max_train).mapInArrow(
        run, "lang string, script boolean, gram string, n long").groupBy("lang", "script", "gram").agg(
        F.sum("n").alias("n")), "gram-counts")
    kept = counts.where("not script").groupBy("gram").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "gram").limit(n_grams).select("gram")
    rows = counts.where("not script").join(kept, "gram").toArrow().to_pylist()
    scripts = counts.where("script").toArrow().to_pylist()
    languages = sorted({r["lang"] for r in scripts})
    number = {x: i for i, x in enumerate(languages)}
    table: dict[str, np.ndarray] = {}
    for r in rows:
        table.setdefault(r["gram"], np.zeros(len(languages)))[number[r["lang"]]] = r["n"]
    total = sum(table.values(), np.zeros(len(languages))) + ALPHA * (len(table) + 1)
    seen = {s: np.zeros(len(languages)) for s in sorted({r["gram"] for r in scripts})}
    for r in scripts:
        seen[r["gram"]][number[r["lang"]]] = r["n"]
    by_language = sum(seen.values(), np.zeros(len(languages)))
    scores = np.log((np.array([*table.values(), np.zeros(len(languages))]) + ALPHA) / total)
    return Model(languages, list(table), scores, {s: n > SCRIPT_SHARE * by_language for s, n in seen.items()})


def languages(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score and
    ``spans``: (first word, words, language) of each run of one language."""
    model = train(docs, max_train)
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = model.languages
        for batch in slices(batches, 2048):
            texts = batch.column(1).to_pylist()
            paths = model.label(texts) if names else [()] * len(texts)
            lang, score, spans = [], [], []
            for path in paths:
                if not len(path):
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    spans.append([])
                    continue
                n = np.bincount(path, minlength=len(names))
                lang.append(names[int(n.argmax())])
                score.append(float(n.max() / len(path)))
                cut = np.r_[0, np.flatnonzero(np.diff(path)) + 1, len(path)]
                spans.append([{"first": int(a), "words": int(b - a), "lang": names[path[a]]}
                              for a, b in zip(cut, cut[1:])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(spans, span)], ["doc_id", "lang_pred", "score", "spans"])

    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, "
             "spans array<struct<first:int,words:int,lang:string>>")
    return found.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
                        "lang_pred", "score", "spans")
