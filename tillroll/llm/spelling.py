"""Spelling variants: words one edit apart, by blocked Gram matrices of letter counts.

Words are the maximal runs of Latin letters of whole texts, counted in the tasks before
the shuffle. One edit changes a word's letter counts little: a replaced letter
gives counts at squared distance two, an inserted or deleted one at distance one. So the
vocabulary is cut into blocks by length and by the counts of a few letter groups (the
block's profile), and only blocks whose profiles one edit can join are compared: the
block with itself, with one group up and another down, and with one group up. For
such a pair of blocks NumPy gives all squared distances at once, ``|x|^2 + |y|^2 - 2 x.y``
with one matrix product; the pairs at distance two at most (same length) or one
(adjacent lengths) are verified letter by letter.

Bounds: the number of letter groups follows the size of the vocabulary, so a block's mean size
stays near ``BLOCK_WORDS``; a block beyond that is cut into chunks by a hash of the word
and compared chunk by chunk, so no task holds more than two chunks. This is exact at
every setting: profiles only leave out pairs that no single edit can join.

A word's form is its near word of largest count, where that is ``RATIO`` times its own or
more (ties: the smallest word); the root follows forms to the last. Counts grow along a
chain at least fivefold, so it ends; roots are found by pointer doubling.

Cases: a null text has no words; a null doc_id counts as the empty text in the hash;
null and repeated ids and repeated rows count as they stand; other columns are
ignored; an empty table gives an empty result; a word without a near word has
``n_near`` 0, no form, and is its own root.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices, stored

MIN_LENGTH, MIN_COUNT, RATIO, EVERY = 6, 5, 5, 199
BLOCK_WORDS, BLOCK_CHARS, FLUSH = 512, 65536, 200_000
#: Letters beyond a-z of the alphabet (fixed by the contract), and a-z by their usual frequency,
#: which deals them evenly to the groups.
BEYOND = "".join(map(chr, range(0xC0, 0x100)))
BY_FREQUENCY = "etaoinshrdlcumwfgypbvkjxqz"
_RUN = re.compile("[a-zÀ-ÿ]+")


def spelled(run: str, prefix_crc: int, every: int = EVERY) -> str:
    """``run``, or without one letter where ``every`` divides the hash of ``<doc_id>:<run>``."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, every: int = EVERY) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` letters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            part = pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                ["word", "n"])
            found.clear()
            return part

        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # bytes.lower changes A-Z alone
                runs = Counter(_RUN.findall(text.lower().decode("utf-8", "replace")))
                crc = zlib.crc32(f"{doc_id}:".encode())
                for r, n in runs.items():
                    if len(r) >= min_length and len(word := spelled(r, crc, every)) >= min_length:
                        found[word] += n
                if len(found) >= FLUSH:
                    yield out()
        yield out()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_groups(n_groups: int) -> list[str]:
    letters = BY_FREQUENCY + BEYOND
    return [letters[g::n_groups] for g in range(n_groups)]


def _groups_for(n_words: int, block_words: int) -> int:
    """Groups that keep the mean block near ``block_words``: each more cuts it about fourfold."""
    n, mean = 1, n_words / 4
    while mean > block_words and n < len(BY_FREQUENCY):
        n, mean = n + 1, mean / 4
    return n


def _key(profile: Column) -> Column:
    return F.array_join(profile, ",")


def blocks_of(words: DataFrame, n_groups: int, block_chars: int) -> tuple[DataFrame, DataFrame]:
    """(key, profile, chunks) of every block, and its chunks (key, chunk, length, text, ns): the
    chunk's words, all of one length, written one after the other, and their counts."""
    length = F.length("word")
    counts = [length - F.length(F.translate("word", g, "")) for g in letter_groups(n_groups)]
    keyed = stored(words.select("word", "n", F.array(*counts).alias("profile")).withColumn(
        "key", _key(F.col("profile"))), "keyed-words")
    width = F.greatest(F.max(length), F.lit(block_chars // (2 * BLOCK_WORDS)))
    sizes = stored(keyed.groupBy("key").agg(
        F.any_value("profile").alias("profile"),
        F.ceil(F.count("*") * width / block_chars).cast("int").alias("chunks")), "blocks")
    dealt = keyed.join(sizes.select("key", "chunks"), "key").groupBy(
        "key", F.expr("cast(pmod(xxhash64(word), chunks) as int)").alias("chunk")).agg(
        F.max(length).alias("length"), F.collect_list(F.struct("word", "n")).alias("w"))
    return sizes, stored(dealt.select(
        "key", "chunk", "length", F.array_join("w.word", "").alias("text"), F.col("w.n").alias("ns")),
        "chunks")


def block_pairs(sizes: DataFrame, n_groups: int) -> DataFrame:
    """(key_a, chunk_a, key_b, chunk_b) of all pairs of chunks that one edit can join, once each."""
    unit = np.eye(n_groups, dtype=int)
    steps = [unit[0] * 0, *unit, *(unit[i] - unit[j] for i in range(n_groups) for j in range(i))]
    step = F.explode(F.array(*(F.array(*map(F.lit, s.tolist())) for s in steps)))
    moved = sizes.select("key", "profile", "chunks", step.alias("step")).select(
        F.col("key").alias("key_a"), F.col("chunks").alias("chunks_a"),
        _key(F.zip_with("profile", "step", lambda x, y: x + y)).alias("key_b"))
    met = moved.join(sizes.select(F.col("key").alias("key_b"), F.col("chunks").alias("chunks_b")), "key_b")
    split = met.withColumn("chunk_a", F.explode(F.sequence(F.lit(0), F.col("chunks_a") - 1))).withColumn(
        "chunk_b", F.explode(F.sequence(F.lit(0), F.col("chunks_b") - 1)))
    return split.where("key_a <> key_b OR chunk_a <= chunk_b").select("key_a", "chunk_a", "key_b", "chunk_b")


def letters_of(text: str, length: int) -> np.ndarray:
    """The words of a chunk as rows of letters (the alphabet fits one byte a letter)."""
    return np.frombuffer(text.encode("latin-1"), np.uint8).reshape(-1, length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """Counts of the 256 byte values in each row; exact as floats, since a squared norm is at
    most the length squared (single precision below 2**24)."""
    n, length = letters.shape
    at = letters + np.arange(n, dtype=np.int64)[:, None] * 256
    counts = np.bincount(at.ravel(), minlength=n * 256).reshape(n, 256)
    return counts.astype(np.float32 if length < 2048 else np.float64)


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i of a, j of b) that one edit turns into each other; ``a`` is as long as ``b`` or
    shorter by one. ``same``: the two are one chunk, and each pair is given once."""
    x, y = letter_counts(a), letter_counts(b)
    used = x.any(0) | y.any(0)
    x, y = x[:, used], y[:, used]
    apart = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(apart == (2 if a.shape[1] == b.shape[1] else 1))
    if same:
        i, j = i[i < j], j[i < j]
    if a.shape[1] == b.shape[1]:
        near = (a[i] != b[j]).sum(1) == 1
    else:
        length = a.shape[1]
        head, tail = a[i] != b[j, :length], (a[i] != b[j, 1:])[:, ::-1]
        first = np.where(head.any(1), head.argmax(1), length)  # equal letters from the start
        last = np.where(tail.any(1), tail.argmax(1), length)  # and from the end
        near = first + last >= length
    return i[near], j[near]


def _near_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 256):
        out: list[list] = [[], [], [], []]
        for same, length_a, text_a, ns_a, length_b, text_b, ns_b in zip(
                *(c.to_pylist() for c in batch.columns)):
            if length_a > length_b:
                length_a, text_a, ns_a, length_b, text_b, ns_b = length_b, text_b, ns_b, length_a, text_a, ns_a
            i, j = near_pairs(letters_of(text_a, length_a), letters_of(text_b, length_b), same)
            for p, q in zip(i.tolist(), j.tolist()):
                u, v = text_a[p * length_a:(p + 1) * length_a], text_b[q * length_b:(q + 1) * length_b]
                for column, values in zip(out, ((u, v), (v, u), (ns_a[p], ns_b[q]), (ns_b[q], ns_a[p]))):
                    column.extend(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
             pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())], ["word", "near", "n", "near_n"])


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, near, n, near_n) for all ordered pairs of ``words`` (word, n; distinct, of the
    letters a-z and U+00C0 to U+00FF) that differ by one inserted, deleted or replaced letter."""
    n_groups = _groups_for(words.count(), block_words)
    sizes, chunks = blocks_of(words, n_groups, block_chars)
    side = lambda s: chunks.select(*(F.col(c).alias(f"{c}_{s}") for c in chunks.columns))
    pairs = block_pairs(sizes, n_groups).join(side("a"), ["key_a", "chunk_a"]).join(
        side("b"), ["key_b", "chunk_b"])
    same = (F.col("key_a") == F.col("key_b")) & (F.col("chunk_a") == F.col("chunk_b"))
    return pairs.select(same, "length_a", "text_a", "ns_a", "length_b", "text_b", "ns_b").mapInArrow(
        _near_of_chunks, "word string, near string, n long, near_n long")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) for a table (word, form) of links that form no ring: the last form."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(at.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             ratio: int = RATIO, every: int = EVERY, **blocks) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text) with at least ``min_count`` occurrences:
    word, form, root, n, n_near and form_n."""
    words = stored(word_counts(docs, min_length, every).where(F.col("n") >= min_count), "words")
    best = near_words(words, **blocks).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    takes = -F.col("best.minus") >= ratio * F.col("n")
    found = stored(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best.near")).alias("form"),
        F.when(takes, -F.col("best.minus")).alias("form_n")), "forms")
    roots = roots_of(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
