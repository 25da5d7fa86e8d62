"""SimHash near-duplicates by Golay-code fuzzy hashing.

A text's fingerprint has 64 bits: A-Z lowered, words split at white space,
``width``-word shingles hashed by XXH64 (seed 42), a bit set where over half of
the hashes have it. Two fingerprints link at ``MAX_BITS`` = 4 or fewer
differing bits.

Candidates. The fingerprint is cut into segments of 23, 23 and 18 bits. The
perfect binary Golay code (23, 12, 7) decodes a segment to the codewords within
distance 4: one if the nearest is within 2, else six. Two segments with at most 2
differing bits share such a codeword, because their midpoint is within 3 of one.
Four errors over three segments leave, by the pigeonhole principle, either one
segment exact and another with at most 2 errors, or at most 1 error in two
segments, which then each have an exact half, and at most 2 in the third. So each
fingerprint has these keys, and linked fingerprints share one of them:

* an exact segment and a codeword of another one (6 ordered pairs), or
* a codeword of one segment and an exact half of both others (3 x 4 ways).

Only distinct fingerprints are keyed, so copies cost nothing. Keys are dealt and
sorted by Spark; each run of equal keys is verified by the bit distance, and gives
a spanning forest of its links, never all pairs. Runs of more than ``RUN`` rows are
cut into blocks by a hash and dealt anew as pairs of blocks, so that each pair of
fingerprints still meets.

Cases: a null or empty text has fingerprint zero, linked like any other; a text with
fewer words than ``width`` is one shingle; null ids keep their row and never name a
component that has another id (a component without ids has a null
``component_id``); repeated rows and ids each keep their row; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import slices, stored
from tillroll.llm.components import connected_components

WIDTH, MAX_BITS = 4, 4
RUN, BLOCK, ALL_PAIRS = 4096, 2048, 8
#: Generator polynomial of the Golay code; segments as (first bit, bits).
GOLAY, SEGMENTS = 0xAE3, ((0, 23), (23, 23), (46, 18))


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """The 64-bit fingerprint of a UTF-8 text as an unsigned integer."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = ends - size + 1
    if len(words) > width:
        starts, ends = starts[: 1 - width or None], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, seed = xxhash.xxh64_intdigest, 42
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())),
                         np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at: at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_column(text: Column, width: int = WIDTH) -> Column:
    """The fingerprints of a string column as signed longs."""
    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array([_signed(fingerprint(t.as_py(), width)) for t in texts], pa.int64())

    return fp(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


@cache
def _error_patterns() -> np.ndarray:
    """For each of the 2048 syndromes the errors of weight 4 or less that have it, as
    rows of six (the coset leader repeated where there is only one)."""
    bits = [1 << i for i in range(23)]
    left = np.zeros((2048, 6), np.uint32)
    n = np.zeros(2048, np.int64)
    errors = [0]
    for weight in range(5):
        for e in errors:
            s = _remainder(e)
            if n[s] == 0:
                left[s] = e
            left[s, n[s]] = e
            n[s] += 1
        errors = [e | b for e in errors for b in bits if b > e]  # a bit above the highest so far
    return left


def _remainder(word: int) -> int:
    for i in range(22, 10, -1):
        if word >> i & 1:
            word ^= GOLAY << (i - 11)
    return word


def _syndromes(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), np.uint32)
    for i in range(23):
        out ^= (words >> np.uint32(i) & np.uint32(1)) * np.uint32(_remainder(1 << i))
    return out


def nearby_codewords(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords within distance 4 of 23-bit words, six columns
    (one index repeated where only one codeword is that near)."""
    errors = _error_patterns()[_syndromes(words)]
    return (words[:, None] ^ errors) >> np.uint32(11)


def fuzzy_keys(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, rows) for each way of keying: the key's number, its exact bits, its codeword."""
    whole = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)) for at, n in SEGMENTS]
    codes = [nearby_codewords(w.astype(np.uint32)).astype(np.uint64) for w in whole]
    halves = [(w & np.uint64((1 << (n + 1) // 2) - 1), w >> np.uint64((n + 1) // 2))
              for w, (_, n) in zip(whole, SEGMENTS)]
    exact = [(q, whole[p]) for p in range(3) for q in range(3) if p != q]
    for t in range(3):
        u, v = (x for x in range(3) if x != t)
        exact += [(t, a << np.uint64(12) | b) for a in halves[u] for b in halves[v]]
    for way, (t, bits) in enumerate(exact):
        keys = np.uint64(way << 36) | bits[:, None] << np.uint64(12) | codes[t]
        new = np.ones(keys.shape, bool)
        new[:, 1:] = codes[t][:, 1:] != codes[t][:, :1]
        rows = np.broadcast_to(np.arange(len(fps))[:, None], keys.shape)
        yield keys[new], rows[new]


def _keyed(fps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            signed = batch.column(0).to_numpy(zero_copy_only=False)
            for keys, rows in fuzzy_keys(signed.view(np.uint64)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(signed[rows])], ["key", "fp"])

    return fps.mapInArrow(run, "key long, fp long")


def _near(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= MAX_BITS  # of signed: of the magnitude


def _forest(members: np.ndarray) -> tuple[list, list]:
    """Spanning forest of the links among distinct fingerprints."""
    a, b, rest = [], [], members
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            hit = _near(rest, x)
            if hit.any():
                found = rest[hit]
                a.extend([x] * len(found))
                b.extend(found.tolist())
                todo.extend(found)
                rest = rest[~hit]
    return a, b


def _links(keyed: DataFrame, longest: int | None) -> DataFrame:
    """(key, a, b) of verified links; rows of longer runs come back as (key, fp, null)."""
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def out(key, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
            schema=schema)

    def complete(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        a, b = [], []
        for gap in range(1, ALL_PAIRS):  # short runs: compare with the next, the one after, ...
            at = first[(size > gap) & (size <= ALL_PAIRS)]
            n = size[(size > gap) & (size <= ALL_PAIRS)] - gap
            if not len(at):
                break
            i = np.repeat(at - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            hit = i[_near(fps[i], fps[i + gap])]
            a.append(fps[hit])
            b.append(fps[hit + gap])
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            yield out(np.zeros(len(a), np.int64), a, b)
        for at, n in zip(first[size > ALL_PAIRS], size[size > ALL_PAIRS]):
            if longest and n > longest:
                yield out(keys[at:at + n], fps[at:at + n], [None] * n)
            else:
                a, b = _forest(fps[at:at + n])
                yield out([0] * len(a), a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = fps = np.zeros(0, np.int64)
        hot = None  # the key of a long run that has not ended
        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy(zero_copy_only=False)]
            fps = np.r_[fps, batch.column(1).to_numpy(zero_copy_only=False)]
            if hot is not None:
                n = int(np.searchsorted(keys, hot, "right"))
                yield out(keys[:n], fps[:n], [None] * n)
                keys, fps = keys[n:], fps[n:]
            if not len(keys):
                continue
            hot = None
            cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last run may go on
            yield from complete(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
            if longest and len(keys) > longest:
                yield out(keys, fps, [None] * len(keys))
                hot, keys, fps = int(keys[0]), keys[:0], fps[:0]
        yield from complete(keys, fps)

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(
        run, "key long, a long, b long")


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints (``fp``) as all links would."""
    first = stored(_links(_keyed(fps), RUN), "links")
    long_runs = first.where("b is null").select("key", F.col("a").alias("fp"))
    blocks = long_runs.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("n"))
    dealt = long_runs.join(blocks, "key").select(
        "key", "fp", F.expr("pmod(xxhash64(fp), n)").alias("i"),
        F.explode(F.expr("sequence(0L, n - 1)")).alias("j"))
    dealt = dealt.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "fp")
    return first.where("b is not null").select("a", "b").union(
        _links(dealt, None).select("a", "b"))


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (hex), component_id
    (smallest doc_id that links reach), component (the smallest fingerprint reached, as a
    signed long), fp (the fingerprint as a signed long) and content (md5 of the text)."""
    rows = stored(docs.select("doc_id", fingerprint_column(F.col("text"), width).alias("fp"),
                              _content().alias("content")), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    found = stored(connected_components(links(fps.select("fp"))), "components")
    named = fps.join(found, fps["fp"] == found["node"])
    names = stored(named.groupBy("component").agg(F.min("first").alias("name")), "names")
    labels = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").join(
        names, "component", "left")
    labels = stored(labels.select("fp", F.coalesce("component", "fp").alias("component"),
                                  F.coalesce("name", "first").alias("component_id")), "labels")
    return rows.join(labels, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        "component", "fp", "content")


def _content() -> Column:
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row of ``docs``, all columns, of each group of near-duplicates: the one with the
    smallest doc_id (a null id only where the group has no other)."""
    groups = near_duplicates(docs, width)
    best = groups.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "content")).alias("b"))
    best = stored(best.select(_row_key(F.col("b.doc_id"), F.col("b.content")).alias("__key")), "keepers")
    rows = docs.select(F.struct("*").alias("row"), _row_key(F.col("doc_id"), _content()).alias("__key"))
    ties = Window.partitionBy("__key").orderBy(*(
        F.col("row").getField(f.name) for f in docs.schema if isinstance(f.dataType, T.AtomicType)))
    return rows.join(best, "__key").withColumn("n", F.row_number().over(ties)).where("n = 1").select(
        "row.*")


def _row_key(doc_id: Column, content: Column) -> Column:
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("none")), F.lit(":"), content)
