"""Language-model scores of texts: a word model with add-one counts (the base), and the
marginal likelihood of a subword lattice.

Words are counted over the training documents (those outside the held-out fold), with
one end token a document. The lattice of a word has the pieces of an existing vocabulary
as arcs, and its byte pieces for characters without a piece. The file's own scores are merge ranks and
no probabilities, so the pieces' are estimated: counts of the vocabulary's cuts of the training
words, then ``ROUNDS`` of expectation maximisation over all their segmentations, with one added to
each count. The end is a piece too, so the pieces' probabilities sum to one and
a text's is the sum over all its segmentations into pieces, up to its end. No piece
crosses a word, so that sum is the product of the words' marginals, each by the forward recursion in
log space (words of one length at once), and of the end's probability.

Every distinct word of the corpus is counted and scored once, in a table that grows
with it. Documents look their words up in two tiers: the ``FREQUENT`` commonest words
(at most ``LONGEST`` bytes each) are sent to the workers, the others are
joined. So no common word is shuffled with its documents, and the tier's size is bounded.

Cases: a null or empty text has the end token alone; null ids are held out or not as the
empty text is (crc32 0, so they train); null and repeated ids and repeated rows keep
their rows and count as often as they stand; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bpe import vocabulary_path
from tillroll.llm.common import held_out, slices, stored

VOCABULARY = "piece_bpe_32k.model"
FOLDS, FOLD = 7, 2
FREQUENT, LONGEST, FLUSH, NO_PIECE = 200_000, 64, 200_000, -50.0
#: Rounds of expectation maximisation; longer words count by the vocabulary's cut, and are scored one by one.
ROUNDS, MANY_CHARS = 2, 64
#: Fixed value: the mark that starts a word in the pieces.
MARK = "▁"
END = ""  # no word is empty


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of every distinct word of all documents and the end token; c counts the
    training documents' only (null id: see the module)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w for w in found], pa.binary()).cast(pa.string())
            part = pa.RecordBatch.from_arrays([words, pa.array(found.values(), pa.int64())], ["word", "c"])
            found.clear()
            return part

        for batch in slices(batches):
            for held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                words.append(b"")
                if held:
                    for w in words:
                        found[w] += 0
                else:
                    found.update(words)
                if len(found) >= FLUSH:
                    yield out()
        yield out()

    rows = docs.select(held_out(F.col("doc_id"), FOLDS, FOLD).alias("held"), _bytes())
    return rows.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _bytes() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")


@cache
def pieces_of(path: str):
    """The segmenter of a vocabulary file, its piece strings, and the ids of its byte pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    bytes_ = {int(n[3:5], 16): i for i, n in enumerate(names) if sp.is_byte(i)}
    return sp, names, bytes_


class Lattice:
    """Log probabilities (natural) of pieces, and the marginal probability of words.
    ``counts`` are of the pieces, ``ends`` those of the end."""

    def __init__(self, names: list[str], byte_ids: dict[int, int], counts: np.ndarray, ends: float):
        # control pieces make no text: only pieces that can stand in a word share the mass
        bytes_ = set(byte_ids.values())
        usable = [i for i, n in enumerate(names) if i in bytes_
                  or not (n.startswith("<") and n.endswith(">") and len(n) > 2)]
        total = math.log(float(counts[usable].sum()) + len(usable) + ends + 1)
        self.logp = np.log(counts + 1.0) - total
        self.end = math.log(ends + 1) - total
        self.piece = {names[i]: i for i in usable if i not in bytes_}
        self.bytes = byte_ids
        self.longest = max(map(len, self.piece))
        # pieces by a 64-bit hash of their characters, behind a table of the hashes' first bits
        found = [(_hashes([t for t, _ in same])[:, 0], [i for _, i in same])
                 for same in _same_length(sorted(self.piece.items(), key=lambda p: len(p[0])))]
        hashes = np.concatenate([h for h, _ in found])
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.concatenate([i for _, i in found])[order].astype(np.int32)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[hashes >> np.uint64(42)] = True

    def spelled(self, char: str) -> list[int]:
        """A character as its byte pieces; a byte without a piece (-1) is next to impossible."""
        return [self.bytes.get(b, -1) for b in char.encode()]

    def spelled_logp(self, char: str) -> float:
        return sum(float(self.logp[i]) if i >= 0 else NO_PIECE for i in self.spelled(char))

    def marginal(self, word: str) -> float:
        """log of the sum over all segmentations of one word: alpha[i] sums over the pieces that end
        at character i."""
        text, get, logp, longest = MARK + word, self.piece.get, self.logp, self.longest
        alpha = [0.0]
        for end in range(1, len(text) + 1):
            ways = [alpha[at] + float(logp[i]) for at in range(end - longest if end > longest else 0, end)
                    if (i := get(text[at:end])) is not None]
            ways.append(alpha[-1] + self.spelled_logp(text[end - 1]))
            top = max(ways)
            alpha.append(top + math.log(sum([math.exp(x - top) for x in ways])))
        return alpha[-1]

    def arcs(self, words: list[str]) -> np.ndarray:
        """Piece numbers (-1: none) of words of one length: [end - 1, size - 1, word]."""
        codes = _codes([MARK + w for w in words])
        n = codes.shape[1]
        out = np.full((n, min(n, self.longest), len(words)), -1, np.int32)
        h = np.zeros(codes.shape, np.uint64)
        for size in range(1, out.shape[1] + 1):
            h = h[:, :n - size + 1] * BASE + codes[:, size - 1:]
            word, at = np.nonzero(self.maybe[_mixed(h) >> np.uint64(42)])
            keys = _mixed(h[word, at])
            place = np.minimum(np.searchsorted(self.hashes, keys), len(self.hashes) - 1)
            hit = self.hashes[place] == keys
            out[at[hit] + size - 1, size - 1, word[hit]] = self.numbers[place[hit]]
        return out

    def forward(self, words: list[str], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(weights of the arcs, weights of spelled characters, alpha) in log, words of one length."""
        weights = np.where(ids >= 0, self.logp[ids], -np.inf)
        n = len(ids)
        chars = {c: self.spelled_logp(c) for c in {MARK, *"".join(words)}}
        spelled = np.array([[chars[c] for c in MARK + w] for w in words]).T
        alpha = np.zeros((n + 1, len(words)))
        for end in range(1, n + 1):
            k = min(end, ids.shape[1])
            ways = np.concatenate([alpha[end - k:end][::-1] + weights[end - 1, :k],
                                   (alpha[end - 1] + spelled[end - 1])[None]])
            alpha[end] = np.logaddexp.reduce(ways, axis=0)
        return weights, spelled, alpha

    def marginals(self, words: list[str]) -> list[float]:
        """``marginal`` of many words."""
        out = np.empty(len(words))
        for same in by_length(words):
            part = [words[i] for i in same]
            if len(part[0]) > MANY_CHARS:
                out[same] = [self.marginal(w) for w in part]
            else:
                out[same] = self.forward(part, self.arcs(part))[2][-1]
        return out.tolist()

    def expected(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """Expected numbers of the pieces over all segmentations of words of one length."""
        ids = self.arcs(words)
        weights, spelled, alpha = self.forward(words, ids)
        n, sizes = ids.shape[:2]
        beta = np.zeros((n + 1, len(words)))
        for at in range(n - 1, -1, -1):
            k = min(n - at, sizes)
            steps = np.arange(k)
            ways = np.concatenate([beta[at + 1:at + 1 + k] + weights[at + steps, steps],
                                   (beta[at + 1] + spelled[at])[None]])
            beta[at] = np.logaddexp.reduce(ways, axis=0)
        total = alpha[-1]
        counts = np.zeros(len(self.logp))
        for end in range(1, n + 1):
            k = min(end, sizes)
            share = np.exp(alpha[end - k:end][::-1] + weights[end - 1, :k] + beta[end] - total) * times
            held = ids[end - 1, :k] >= 0
            counts += np.bincount(ids[end - 1, :k][held], share[held], len(counts))
            rest = np.exp(alpha[end - 1] + spelled[end - 1] + beta[end] - total) * times
            for i in np.flatnonzero(rest > 1e-9).tolist():
                for piece in self.spelled((MARK + words[i])[end - 1]):
                    counts[piece] += rest[i] if piece >= 0 else 0.0
        return counts


BASE = np.uint64(0x100000001B3)


def _codes(texts: list[str]) -> np.ndarray:
    """Code points (and one) of texts of one length."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), -1)
    return flat.astype(np.uint64) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _hashes(texts: list[str]) -> np.ndarray:
    codes = _codes(texts)
    h = np.zeros(len(texts), np.uint64)
    for i in range(codes.shape[1]):
        h = h * BASE + codes[:, i]
    return _mixed(h)[:, None]


def _same_length(items: list[tuple[str, int]]) -> Iterator[list[tuple[str, int]]]:
    return (list(same) for _, same in groupby(items, key=lambda p: len(p[0])))


def by_length(words: list[str]) -> list[np.ndarray]:
    """Indices of words of one length, at most 1024 at a time."""
    size = np.array([len(w) for w in words])
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    return [part for same in np.split(order, cuts) for part in np.split(same, range(1024, len(same), 1024))
            if len(part)]


def piece_counts(words: DataFrame, path: str, lattice: Lattice | None = None) -> np.ndarray:
    """How often each piece stands in the training words (word, c): by the vocabulary's own cut, or
    with a lattice as expected over all segmentations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, names, _ = pieces_of(path)
        n = np.zeros(len(names))

        def cut(words: list[str], times: np.ndarray) -> None:
            ids = sp.encode(words, num_threads=1)
            flat = np.array([i for x in ids for i in x], np.int64)
            np.add.at(n, flat, np.repeat(times, [len(x) for x in ids]))

        for batch in slices(batches, 4096):
            words, times = batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float)
            if lattice is None:
                cut(words, times)
                continue
            for same in by_length(words):
                part = [words[i] for i in same]
                if len(part[0]) > MANY_CHARS:
                    cut(part, times[same])
                else:
                    n += lattice.expected(part, times[same])
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], ["piece", "n"])

    found = words.where("c > 0 and word <> ''").select("word", "c").mapInArrow(
        run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()  # a row a piece
    counts = np.zeros(len(pieces_of(path)[1]))
    counts[found.column("piece").to_numpy()] = found.column("n").to_numpy()
    return counts


def word_table(docs: DataFrame, path: str) -> tuple[DataFrame, int, int]:
    """(word, c, logp) with logp in log10, the training tokens and the distinct ones."""
    words = stored(word_counts(docs), "word-counts")
    n = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    trained, distinct = n[0], n[1]
    ends = words.where(F.col("word") == END).agg(F.coalesce(F.max("c"), F.lit(0))).first()[0]
    _, names, byte_ids = pieces_of(path)
    counts = piece_counts(words, path)
    for _ in range(ROUNDS):
        counts = piece_counts(words, path, Lattice(names, byte_ids, counts, ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(names, byte_ids, counts, ends)
        for batch in slices(batches, 8192):
            logp = [lattice.end if w == END else x for w, x in zip(
                batch.column(0).to_pylist(), lattice.marginals(batch.column(0).to_pylist()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(logp) / math.log(10), pa.float64())],
                ["word", "c", "logp"])

    scored = words.select("word", "c").mapInArrow(run, "word string, c long, logp double")
    return stored(scored, "scored-words"), trained, distinct


def frequent_words(words: DataFrame, frequent: int) -> DataFrame:
    """At most ``frequent`` of the commonest words: all above a count that a histogram of the counts'
    logarithms gives (which words these are makes no difference to any score)."""
    short = words.where(F.octet_length("word") <= LONGEST)
    level = F.floor(F.log2(F.col("c") + 1) * 8)
    total, least = 0, 0
    for row in short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # < 512 rows
        total += row["count"]
        if total > frequent:
            least = row["level"] + 1
            break
    return short.where(level >= least)


def lm_scores(docs: DataFrame, path: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score and score (log10)."""
    path = path or vocabulary_path(VOCABULARY)
    words, n_train, n_distinct = word_table(docs, path)
    common = frequent_words(words, frequent).toArrow().combine_chunks()
    sent = docs.sparkSession.sparkContext.broadcast(
        ("\n".join(common.column("word").to_pylist()).encode(),
         common.column("c").to_numpy().tobytes(), common.column("logp").to_numpy().tobytes()))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        joined, c, logp = sent.value
        c = np.frombuffer(c, np.int64)
        number = {w: i for i, w in enumerate(joined.split(b"\n"))} if len(c) else {}
        base, logp = np.log10(c + 1.0), np.frombuffer(logp, np.float64)
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches, 256):
            out = {k: [] for k in ("row", "n", "known", "base", "score", "rare", "times")}
            for text in batch.column(1).to_pylist():
                tokens = words_of(text)
                tokens.append(b"")
                places = [number.get(w, -1) for w in tokens]
                at = np.array(places, np.int64)
                hit = at[at >= 0]
                rare = Counter([w for w, i in zip(tokens, places) if i < 0])
                row += 1
                for k, v in (("row", row), ("n", len(tokens)), ("known", int((c[hit] > 0).sum())),
                             ("base", float(base[hit].sum())), ("score", float(logp[hit].sum())),
                             ("rare", [w.decode() for w in rare]), ("times", list(rare.values()))):
                    out[k].append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     pa.list_(pa.string()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, t) for v, t in zip(out.values(), kinds))],
                ["doc_id", *out])

    rows = stored(docs.select("doc_id", _bytes()).mapInArrow(
        run, f"doc_id {kind}, row long, n long, known long, base double, score double, "
             "rare array<string>, times array<int>"), "looked-up")
    pairs = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select(
        "row", F.col("p.rare").alias("word"), F.col("p.times").alias("times"))
    rest = pairs.join(words, "word").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more_base"),
        F.sum(F.col("times") * F.col("logp")).alias("more_score"))
    unit = math.log10(n_train + n_distinct + 1)
    zero = F.lit(0)
    return rows.join(rest, "row", "left").select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
        F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) - F.col("n") * unit).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero)).alias("score"))
