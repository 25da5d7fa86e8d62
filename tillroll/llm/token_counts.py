"""Token counts by a two-tier lookup, map-side only.

A text is normalised (NFC, lower case) and cut into pre-tokens as the tokenizer does;
its count is the sum of its pre-tokens' lengths in tokens. Lengths come from two
tiers: a broadcast table of the ``FREQUENT`` commonest pre-tokens of a sample of
``SAMPLE_DOCS`` documents, and in each worker a bounded cache that encodes what
misses it. The table only saves time: a pre-token counts the same whichever tier
has it, so the sample has no part in the results, and no pre-token is shuffled but the
sample's partial counts.

Cases: a null text counts as empty (0 bytes, 0 tokens); special strings in a text are
one token each, as in the library's default; null and repeated ids and repeated
rows keep their rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bpe import byte_symbols, vocabulary_path
from tillroll.llm.common import slices

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
FREQUENT, SAMPLE_DOCS, LONGEST_FREQUENT, CACHE_WORDS = 32_768, 4096, 64, 200_000
#: Fixed value: how the tokenizer splits a normalised text.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class _Lengths(dict):
    """The frequent tier; what it misses is looked up in, or encoded into, the worker's cache."""

    def __init__(self, model, frequent: dict[str, int]):
        super().__init__(frequent)
        self.model, self.cache = model, {}
        self.symbols = byte_symbols()

    def encoded(self, word: str) -> int:
        return len(self.model.tokenize("".join(map(self.symbols.__getitem__, word.encode()))))

    def __missing__(self, word: str) -> int:
        n = self.cache.get(word)
        if n is None:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            n = self.cache[word] = self.encoded(word)
        return n


class Counts:
    def __init__(self, path: str, words: bytes = b"", lengths: bytes = b""):
        from tokenizers import Tokenizer
        spec = Tokenizer.from_file(path)
        special = sorted((t.content for t in spec.get_added_tokens_decoder().values()),
                         key=len, reverse=True)
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        frequent = zip(words.decode().split("\n"), np.frombuffer(lengths, np.uint16).tolist()) \
            if words else ()
        self._spec = spec
        self.lengths = _Lengths(spec.model, dict(frequent))

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text and the number of special strings in it."""
        parts = self.cuts.split(text) if self.cuts else [text]
        found = []
        for part in parts[::2]:
            # capital sigma is lowered without regard to its place in the word
            plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            found += SPLIT.findall(plain)
        return found, len(parts) // 2

    def count(self, text: str) -> int:
        words, special = self.pre_tokens(text)
        return special + sum(map(self.lengths.__getitem__, words))


@cache
def _bare(path: str) -> Counts:
    return Counts(path)


_of_worker: dict[str, tuple[bytes, Counts]] = {}


def _worker_counts(path: str, words: bytes, lengths: bytes) -> Counts:
    """The worker process keeps its parsed vocabulary and its cache from task to task, as long as
    the frequent tier is the same."""
    tier = hashlib.md5(words + lengths).digest()
    if _of_worker.get(path, (None,))[0] != tier:
        _of_worker[path] = tier, Counts(path, words, lengths)
    return _of_worker[path][1]


def frequent_lengths(docs: DataFrame, path: str, size: int = FREQUENT,
                     sample_docs: int = SAMPLE_DOCS) -> tuple[bytes, bytes]:
    """The commonest pre-tokens of the sample, joined by line ends, and their lengths
    (uint16): at most ``size`` times 66 bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                found.update(_bare(path).pre_tokens(text)[0])
        best = [(w, n) for w, n in found.most_common(size) if len(w.encode()) <= LONGEST_FREQUENT]
        yield pa.RecordBatch.from_arrays([
            pa.array([w for w, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())],
            ["word", "n"])

    share = min(1.0, sample_docs / max(1, docs.count()))
    sample = docs.select(_text()).sample(share, 7)
    rows = sample.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "word").limit(size).select("word").collect()
    words = [r["word"] for r in rows]
    lengths = np.array([_bare(path).lengths.encoded(w) for w in words], np.uint16)
    return "\n".join(words).encode(), lengths.tobytes()


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit."""
    path = path or vocabulary_path(VOCABULARY)
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _worker_counts(path, *sent.value)
        for batch in slices(batches):
            n = [counts.count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", F.octet_length(_text()).cast("long").alias("n_bytes"), _text())
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").select(
        "*", (F.col("n_tokens") > limit).alias("over_limit"))
