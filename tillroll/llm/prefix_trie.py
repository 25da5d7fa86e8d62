"""Trie of conversation prefixes in minimal-perfect-hash node tables.

A conversation is a path of turns (role, text); each distinct sequence of its first ``d`` turns
is a node of depth ``d``. A prefix has a digest of two 64-bit numbers: the exclusive or of
hashes of each turn's md5 and its place, so that the digests of all prefixes of a long
conversation come from scans over bands of ``BAND`` turns, and no window holds a whole one.

Nodes are the distinct digests (grouped with partial sums; a digest that two different
prefixes share stops the job). The *weight* of a node is the number of rows (conversation,
depth) at or below it. Nodes above ``limit`` rows are heavy: there are few, always a top part
of the trie. Below it hang light subtrees of at most ``limit`` rows each, and whole
light subtrees are dealt to shards by the hash of their top. A shard is one task's work of
bounded size, with its own table (``NodeTable``): a minimal perfect hash of its digests, built
in levels of bit sets, gives each node its slot and finds its parent's, where the stored digest
is compared (a foreign digest or a collision is told). The shard's counts are scattered into
flat NumPy arrays by slot and accumulated through the array of parent slots, from the deepest
nodes up. What the tops of light subtrees sum up to is then added to the heavy nodes above
them, along the path of one member each, by grouped sums. So a prefix that a third of all
conversations share is never gathered in one task.

The ends of a node (conversations that stop there) are hashed in order, as a stream of sorted
pieces, each the ids of one range of ``ID_RANGE`` numbers.

Cases: rows with a null conv_id are ignored; null roles and texts are empty; turns go by number,
null first, equal numbers by a hash of role and text, then role and text; repeated rows are
turns of their own; other columns are ignored; a conversation without turns is a member of
the root alone; an empty table gives an empty result. The same text under another role is
another turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import stored

MODULUS, HEADS = 5, 9
BAND, LIMIT, ID_RANGE, SALTS = 1024, 8192, 4096, 32
NODE = ["hi", "lo", "depth"]
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def running(rows: DataFrame, order: list[Column], band: list[Column], sums: dict[str, str]) -> DataFrame:
    """``rows`` (with conv_id) and running totals of each conversation: ``sums`` maps new names to
    aggregates in SQL that are their own partial form (``sum``, ``bit_xor``), and
    ``order`` must agree with the order of ``band``. Totals inside a band, then of the bands before."""
    names = [f"_b{i}" for i in range(len(band))]
    keys = ["conv_id", *names]
    merge = {"sum": Column.__add__, "bit_xor": Column.bitwiseXOR}
    kinds = {n: s.partition("(")[0] for n, s in sums.items()}
    banded = rows.select("*", *(b.alias(n) for b, n in zip(band, names)))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv_id").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    starts = banded.groupBy(*keys).agg(*(F.expr(s).alias(n) for n, s in sums.items())).select(
        *(F.col(k).alias(f"_{k}") for k in keys),
        *(F.coalesce(F.expr(f"{kinds[n]}({n})").over(before), F.lit(0)).alias(f"_{n}") for n in sums))
    scanned = banded.select("*", *(F.expr(s).over(inside).alias(n) for n, s in sums.items()))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return scanned.join(starts, same).select(
        *rows.columns, *(merge[kinds[n]](F.col(n), F.col(f"_{n}")).alias(n) for n in sums))


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_md5, n_bytes) of every turn, places from 1."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.octet_length(text).cast("long").alias("n_bytes"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias(
            "turn_md5"))
    h = F.xxhash64("turn_md5")
    # turns without a number have one place in the order: there a band is a range of the hash
    band = [F.floor(F.col("turn") / BAND), F.when(F.col("turn").isNull(), F.shiftright(h, 54))]
    return running(turns.select("*", h.alias("h")), [F.col("turn").asc_nulls_first(), F.col("h"),
                                                      F.col("turn_md5")],
                   band, {"place": "sum(1)"}).select("conv_id", "place", "turn_md5", "n_bytes")


def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("long")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n_turns) of every conversation as rebuilt, and its turns (conv_id, depth, turn_md5,
    n_bytes): the first turns of ``conv_id - conv_id % 5``, then its own from there on."""
    placed = stored(placed_turns(conversations), "placed-turns")
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    base = F.col("conv_id") - F.col("conv_id") % MODULUS
    convs = sizes.select("conv_id", "n_own", base.alias("base"), head_length(F.col("conv_id")).alias("head"))
    found = sizes.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = stored(convs.join(found, "base", "left").select(
        "conv_id", "base", "head", "n_own",
        F.least("head", F.coalesce("n_base", F.lit(0).cast("long"))).alias("n_head")), "conversations")
    heads = placed.where(F.col("place") < HEADS).withColumnRenamed("conv_id", "base")
    first = convs.select("conv_id", "base", "head").join(heads, "base").where("place <= head").select(
        "conv_id", F.col("place").alias("depth"), "turn_md5", "n_bytes")
    rest = placed.join(convs.select("conv_id", "head", "n_head"), "conv_id").where("place > head").select(
        "conv_id", (F.col("place") - F.col("head") + F.col("n_head")).alias("depth"), "turn_md5", "n_bytes")
    return convs.select("conv_id", (F.col("n_head") + F.greatest(
        F.col("n_own") - F.col("head"), F.lit(0).cast("long"))).alias("n_turns")), first.union(rest)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, hi, lo, up_hi, up_lo, turn_md5, n_bytes): each prefix with its digest and that of
    the prefix before (0, 0 for the root)."""
    keyed = turns.select("*", F.xxhash64("depth", "turn_md5").alias("a"),
                         F.xxhash64("turn_md5", "depth", F.lit("low")).alias("b"))
    done = running(keyed, [F.col("depth")], [F.floor(F.col("depth") / BAND)],
                   {"hi": "bit_xor(a)", "lo": "bit_xor(b)"})
    return done.select("conv_id", "depth", "hi", "lo", F.col("hi").bitwiseXOR(F.col("a")).alias("up_hi"),
                       F.col("lo").bitwiseXOR(F.col("b")).alias("up_lo"), "turn_md5", "n_bytes")


def nodes_of(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(hi, lo, depth, up_hi, up_lo, conv_id, n_convs, saved, weight): the distinct prefixes, with
    their smallest member and what they save themselves."""
    known = F.struct("up_hi", "up_lo", "turn_md5", "n_bytes")
    grouped = paths.join(convs, "conv_id").groupBy(*NODE).agg(
        F.min(known).alias("p"), F.max(known).alias("q"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.sum(F.col("n_turns") - F.col("depth") + 1).alias("weight"))
    checked = F.when(F.col("p") == F.col("q"), F.col("n_convs")).otherwise(
        F.raise_error(F.lit("two prefixes have one digest")).cast("long"))
    return grouped.select(*NODE, "p.up_hi", "p.up_lo", "conv_id", checked.alias("n_convs"),
                          ((F.col("n_convs") - 1) * F.col("p.n_bytes")).alias("saved"), "weight")


class NodeTable:
    """Minimal perfect hash of distinct digests (two integer arrays): level by level, the keys that
    fall alone on a bit of the level's set keep it, the others go on; a key's slot is the
    rank of its bit over all levels."""

    GAMMA = 2

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        n = len(hi)
        self.hi, self.lo, self.levels, self.starts = np.zeros(n, np.int64), np.zeros(n, np.int64), [], []
        rest, start = np.arange(n), 0
        self.slots = np.zeros(n, np.int64)
        while len(rest):
            size = self.GAMMA * len(rest)
            at = self._bits(hi[rest], lo[rest], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            ranks = np.cumsum(alone) - 1
            placed = alone[at]
            self.slots[rest[placed]] = start + ranks[at[placed]]
            self.levels.append((alone, ranks))
            self.starts.append(start)
            start += int(alone.sum())
            rest = rest[~placed]
            if len(self.levels) > 200:
                raise ValueError("repeated digests")
        self.hi[self.slots], self.lo[self.slots] = hi, lo

    @staticmethod
    def _bits(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
        h = hi.astype(np.uint64) ^ (lo.astype(np.uint64) * np.uint64(2 * level + 1))
        for multiplier in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ (h >> np.uint64(33))) * np.uint64(multiplier)
        return ((h ^ (h >> np.uint64(33))) % np.uint64(size)).astype(np.int64)

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slots of digests, -1 for those that the table doesn't hold."""
        slots, rest = np.full(len(hi), -1, np.int64), np.arange(len(hi))
        for level, ((alone, ranks), start) in enumerate(zip(self.levels, self.starts)):
            at = self._bits(hi[rest], lo[rest], level, len(alone))
            hit = alone[at]
            slot = start + ranks[at[hit]]
            found = rest[hit]
            same = (self.hi[slot] == hi[found]) & (self.lo[slot] == lo[found])
            slots[found[same]] = slot[same]
            rest = rest[~hit]
        return slots


SHARD_RESULT = ("hi long, lo long, depth long, parent_conv_id long, n_children long, n_leaves long, "
                "saved_tokens long, top boolean")


def accumulate(shard: pa.Table) -> pa.Table:
    """The rows of one shard (hi, lo, depth, up_hi, up_lo, conv_id, saved) to SHARD_RESULT."""
    hi, lo, depth, up_hi, up_lo, conv, saved = (
        shard.column(c).to_numpy() for c in ("hi", "lo", "depth", "up_hi", "up_lo", "conv_id", "saved"))
    table = NodeTable(hi, lo)
    n, slot = len(hi), table.slots
    parent, conv_at, sums, depths = (np.zeros(n, np.int64) for _ in range(4))
    parent[slot] = table.find(up_hi, up_lo)
    conv_at[slot], sums[slot], depths[slot] = conv, saved, depth
    inner = parent >= 0
    children = np.bincount(parent[inner], minlength=n)
    leaves = (children == 0).astype(np.int64)
    order = np.argsort(-depths, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depths[order])) + 1):
        up = level[inner[level]]
        np.add.at(leaves, parent[up], leaves[up])
        np.add.at(sums, parent[up], sums[up])
    at = slot
    return pa.table({
        "hi": hi, "lo": lo, "depth": depth,
        "parent_conv_id": pa.array(conv_at[parent[at]], pa.int64(), mask=~inner[at]),
        "n_children": children[at], "n_leaves": leaves[at], "saved_tokens": sums[at], "top": ~inner[at]})


def _salted(rows: DataFrame, small: DataFrame, on: list[str], by: Column, how: str) -> DataFrame:
    """``rows`` joined with a table of unique ``on``; rows of a hot key are dealt to SALTS tasks."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(
        small.withColumn("_salt", salt), [*on, "_salt"], how).drop("_salt")


def ends_of(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(hi, lo, depth, ends_sha256) of the nodes where conversations end; the root is (0, 0, 0)."""
    last = paths.join(convs.withColumnRenamed("n_turns", "depth"), ["conv_id", "depth"]).select(
        "conv_id", *NODE).union(convs.where("n_turns = 0").select(
            "conv_id", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long")))
    pieces = last.groupBy(*NODE, F.floor(F.col("conv_id") / ID_RANGE).alias("at")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*NODE, "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (*node, state.hexdigest())], [*NODE, "ends_sha256"])

    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "at").select(*NODE, "ids").mapInArrow(
        hashed, "hi long, lo long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256."""
    zero = F.lit(0).cast("long")
    convs, turns = rebuilt(conversations)
    convs = stored(convs, "rebuilt")
    paths = stored(prefixes(turns), "prefixes")
    nodes = stored(nodes_of(paths, convs), "nodes")
    heavy = nodes.where(F.col("weight") > limit)
    # per conversation: its heavy prefixes come first; then the top of its light part
    marked = _salted(paths.select("conv_id", *NODE), heavy.select(*NODE, F.lit(True).alias("heavy")), NODE,
                     F.col("conv_id"), "left")
    light = F.col("heavy").isNull()
    tops = stored(marked.groupBy("conv_id").agg(
        F.max(F.when(~light, F.col("depth"))).alias("n_heavy"),
        F.min(F.when(light, F.struct("depth", "hi", "lo"))).alias("first")).select(
        "conv_id", F.coalesce("n_heavy", zero).alias("n_heavy"),
        F.col("first.hi").alias("top_hi"), F.col("first.lo").alias("top_lo")), "tops")
    n_nodes = nodes.count()
    shards = max(1, n_nodes // limit * 2)
    dealt = nodes.where(F.col("weight") <= limit).join(tops.select("conv_id", "top_hi", "top_lo"), "conv_id")
    done = stored(dealt.select(
        F.pmod(F.xxhash64("top_hi", "top_lo"), F.lit(shards)).alias("shard"), *NODE, "up_hi", "up_lo", "conv_id",
        "saved").groupBy("shard").applyInArrow(accumulate, SHARD_RESULT), "shards")

    # what hangs below each heavy node: sums of its path's members from its depth on
    own = nodes.select(*NODE, "up_hi", "up_lo", "conv_id", "n_convs", "saved", "weight")
    below = done.where("top").select("hi", "lo", "depth", F.col("n_leaves").alias("leaves"),
                                     F.col("saved_tokens").alias("saved"))
    parents = own.groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"),
                          (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    top_part = stored(heavy.join(parents, NODE, "left").select(
        *NODE, "up_hi", "up_lo", "conv_id", F.coalesce("n_children", zero).alias("n_children"), "saved"), "heavy")
    given = top_part.select("conv_id", "depth", F.expr("int(n_children = 0)").cast("long").alias("leaves"), "saved") \
        .union(below.join(nodes.select(*NODE, "conv_id"), NODE).select("conv_id", "depth", "leaves", "saved"))
    heavy_paths = paths.select("conv_id", *NODE).join(tops.select("conv_id", "n_heavy"), "conv_id").where(
        "depth <= n_heavy")
    gifts = given.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    # from the deepest gift up: what a member gives at its depth or below
    upward = heavy_paths.join(gifts.select("conv_id").distinct(), "conv_id").select(
        "conv_id", "depth", "hi", "lo", zero.alias("leaves"), zero.alias("saved")).union(
        gifts.select("conv_id", "depth", F.lit(None).cast("long"), F.lit(None).cast("long"), "leaves", "saved"))
    summed = running(upward, [F.col("depth").desc(), F.col("hi").asc_nulls_first()],
                     [-F.floor(F.col("depth") / BAND)],
                     {"n_leaves": "sum(leaves)", "saved_tokens": "sum(saved)"}).where("hi IS NOT NULL")
    totals = summed.groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"),
                                       F.sum("saved_tokens").alias("saved_tokens"))
    upper = top_part.join(totals, NODE).select(
        *NODE, F.lit(None).cast("long").alias("parent_conv_id"), "n_children", "n_leaves", "saved_tokens",
        F.lit(True).alias("top"))

    # the parent of a top is heavy, or the root
    all_done = nodes.select(*NODE, "up_hi", "up_lo", "conv_id", "n_convs").join(done.union(upper), NODE)
    first = convs.agg(F.min("conv_id").alias("first_conv"), F.count("*").alias("all_convs"))
    outer = _salted(all_done.where("top AND depth > 1"), heavy.select(
        F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("up_conv")), ["up_hi", "up_lo", "depth"], F.col("hi"), "left")
    columns = ["hi", "lo", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    inner = all_done.where("NOT top").select(*columns).union(
        outer.withColumn("parent_conv_id", F.col("up_conv")).select(*columns)).union(
        all_done.where("top AND depth = 1").crossJoin(F.broadcast(first)).withColumn(
            "parent_conv_id", F.col("first_conv")).select(*columns))
    root = nodes.agg(F.count(F.when(F.col("depth") == 1, 1)).alias("n_children"),
                     F.coalesce(F.sum("saved"), zero).alias("saved_tokens"))
    leaves = done.union(upper).agg(F.count(F.when(F.col("n_children") == 0, 1)).alias("n_leaves"))
    root = first.where("all_convs > 0").crossJoin(F.broadcast(root)).crossJoin(F.broadcast(leaves)).select(
        zero.alias("hi"), zero.alias("lo"), F.col("first_conv").alias("conv_id"), zero.alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.col("all_convs").alias("n_convs"), "n_children",
        F.greatest("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), "saved_tokens")
    everything = inner.union(root).join(ends_of(paths, convs), NODE, "left")
    return everything.select(*columns[2:], F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"))
