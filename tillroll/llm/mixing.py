"""Mixing sources to target weights by Pfair scheduling. DataFrame functions only.

Every source cuts its documents, in a hashed order, into blocks of ``BLOCK_DOCS``. A
source with weight ``w`` (a share of 1) gets one slot in ``1 / w``: its block ``i`` is released at
slot ``floor(i / w)`` and has the deadline ``ceil((i + 1) / w)``, and each slot goes to the
released block with the earliest deadline (ties: the source's name). Weights sum to one, so no
deadline is missed, and after any number of slots each source has had less than one block
more or less than its weight asks for, as long as it has blocks left. Slots of an exhausted
source stay empty; every document is placed once.

Weights are whole numbers ``a`` over their total ``A``, so releases and deadlines are exact: the asked
weights over the largest one, in units of ``2 ** -40`` of it.

The schedule is found in parallel, though earliest-deadline-first looks sequential. Slots are
cut into leaves of ``LEAF``. An interval of slots is summed up by which of the blocks released in
it are done (D) when it starts without a backlog, and which are left over (O). Two neighbours
merge by one ranking: the right half does the earliest deadlines among the left's O and
its own D, as many as it has slots, since its own D already fit their releases. Only blocks whose
deadline lies beyond the interval can change, at most one a source, so levels are narrow. Going
down the same tree, the true backlog at the start of each half follows by the same
ranking, until every leaf knows what it starts with and plays its ``LEAF`` slots. The result is
slot for slot what a sequential run gives.

Places inside a source come from a hash cut into ``BUCKETS`` ranges, numbered in each
range and offset by the ranges before, so no source passes through one task. Whole rows
are shuffled once, by source and range, where the slots of the range's blocks wait.

Target weights are a table (source, weight); by default a source's weight is the square root
of its number of documents, which flattens a hot source. A source without a positive
weight gets the smallest positive one (all are alike if there is none).

Cases: a null source is the source with the empty name; null or repeated ids and
repeated rows each get a place of their own; extra columns don't matter; an empty table gives an
empty result. Rows that equal another in id and text lie in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import hash60, let, stored

BLOCK_DOCS, LEAF, UNIT = 16, 64, 1 << 40
#: Hash ranges of a source; a power of two. Blocks that one row makes at once.
BUCKETS, CHUNK = 4096, 4096


def _name(source: Column) -> Column:
    return F.coalesce(source.cast("string"), F.lit(""))


def shares(docs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """(name, n, a, total): documents of every source, its weight as a whole number and the sum."""
    sizes = docs.groupBy(_name(F.col("source")).alias("name")).agg(F.count("*").alias("n"))
    if weights is None:
        asked = sizes.withColumn("w", F.sqrt("n"))
    else:
        given = weights.groupBy(_name(F.col("source")).alias("name")).agg(
            F.sum(F.when(F.col("weight") > 0, F.col("weight"))).cast("double").alias("w"))
        asked = sizes.join(given, "name", "left")
    bounds = asked.agg(F.coalesce(F.max("w"), F.lit(1.0)).alias("most"),
                       F.coalesce(F.min("w"), F.lit(1.0)).alias("least"))
    whole = asked.crossJoin(F.broadcast(bounds)).select("name", "n", F.greatest(F.lit(1), F.round(
        F.coalesce("w", "least") / F.col("most") * UNIT).cast("long")).cast("long").alias("a"))
    whole = stored(whole, "shares")
    return whole.crossJoin(F.broadcast(whole.agg(F.sum("a").alias("total"))))


def jobs_of(sizes: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(name, block, r, d): each block of ``shares`` with its release and deadline."""
    # whole numbers of up to 38 digits: a block's number times the total doesn't fit a long
    times = lambda i: f"CAST({i} AS DECIMAL(18,0)) * CAST(total AS DECIMAL(19,0))"
    chunks = sizes.withColumn("blocks", F.expr(f"(n - 1) div {block_docs} + 1")).select(
        "name", "a", "total", "blocks", F.explode(F.expr(f"sequence(0L, (blocks - 1) div {CHUNK})")).alias("c"))
    return chunks.repartition("name", "c").select("name", "a", "total", F.explode(F.expr(
        f"sequence(c * {CHUNK}, least(blocks, (c + 1) * {CHUNK}) - 1)")).alias("block")).select(
        "name", "block", F.expr(f"({times('block')}) div a").alias("r"),
        F.expr(f"({times('block + 1')} + a - 1) div a").alias("d"))


_JOB = ["d", "name", "block", "r"]  # in the order of priority


def _played(jobs: Column, start: Column) -> Column:
    """(slot, d, name, block, r) of the jobs that earliest-deadline-first does in ``LEAF`` slots."""
    def step(state: Column, slot: Column) -> Column:
        ready = F.array_min(F.filter(state["left"], lambda j: j["r"] <= slot))
        return let(ready, lambda best: F.when(best.isNull(), state).otherwise(F.struct(
            F.filter(state["left"], lambda j: j != best).alias("left"),
            F.array_append(state["done"], F.struct(
                slot.alias("slot"), *(best[c].alias(c) for c in _JOB))).alias("done"))))

    kind = "array<struct<slot:bigint,d:bigint,name:string,block:bigint,r:bigint>>"
    return F.aggregate(F.sequence(start, start + (LEAF - 1)),
                       F.struct(jobs.alias("left"), F.array().cast(kind).alias("done")), step,
                       lambda state: state["done"])


def _leaf_jobs(jobs: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """(node, jobs): what each leaf can do: of the blocks released at one slot the first LEAF by
    priority, and the backlog it starts with."""
    at_slot = Window.partitionBy("r").orderBy("d", "name")
    own = jobs.withColumn("rank", F.row_number().over(at_slot)).where(f"rank <= {LEAF}").select(
        F.expr(f"r div {LEAF}").alias("node"), *_JOB)
    every = own if also is None else own.unionByName(also)
    return every.groupBy("node").agg(F.collect_list(F.struct(*_JOB)).alias("jobs"))


def schedule(jobs: DataFrame) -> DataFrame:
    """(name, block, slot) of every job of ``jobs`` (name, block, r, d)."""
    jobs = stored(jobs.select(*_JOB), "jobs")
    last = jobs.agg(F.max("d")).first()[0]
    if last is None:
        return jobs.select("name", "block", F.lit(0).cast("long").alias("slot"))
    by_priority = Window.partitionBy("node").orderBy("d", "name")
    start = F.col("node") * LEAF

    # up: rows (node, job, done) are the jobs whose deadline lies beyond their node
    alone = stored(_leaf_jobs(jobs).select("node", _played(F.col("jobs"), start).alias("done")), "leaves")
    picked = alone.select("node", F.explode("done").alias("j")).select(
        F.col("j.name").alias("name"), F.col("j.block").alias("block"), F.lit(True).alias("picked"))
    beyond = jobs.withColumn("node", F.expr(f"r div {LEAF}")).where(f"d > (node + 1) * {LEAF}")
    rows = [stored(beyond.join(picked, ["name", "block"], "left").select(
        "node", *_JOB, F.coalesce("picked", F.lit(False)).alias("done")), "beyond")]
    sums = [stored(alone.select("node", F.size("done").cast("long").alias("m")), "sums")]
    size = LEAF
    while size < last:
        half, size = size, 2 * size
        up = F.expr("node div 2")
        left, end = F.expr("node % 2 = 0"), (up + 1) * size
        seen = rows[-1].select(up.alias("node"), left.alias("left"), end.alias("end"), *_JOB, "done")
        counts = sums[-1].select(up.alias("node"), F.when(left, F.col("m")).alias("m_left"),
                                 F.when(~left, F.col("m")).alias("m_right"))
        zero = F.lit(0).cast("long")
        held = counts.groupBy("node").agg(F.coalesce(F.sum("m_left"), zero).alias("m_left"),
                                          F.coalesce(F.sum("m_right"), zero).alias("m_right"))
        over = seen.groupBy("node").agg(
            F.count_if(F.expr("left AND NOT done")).alias("over"),
            F.count_if(F.expr("left AND NOT done AND d <= end")).alias("over_inside"),
            F.count_if(F.expr("NOT left AND done")).alias("right_beyond"))
        both = stored(held.join(over, "node", "full").select(
            "node", *(F.coalesce(c, zero).alias(c) for c in (
                "m_left", "m_right", "over", "over_inside", "right_beyond"))), "merged")
        ranked = seen.where("d > end").withColumn("meets", F.expr("left <> done"))
        ranked = ranked.withColumn("rank", F.when(F.col("meets"), F.row_number().over(
            Window.partitionBy("node", "meets").orderBy("d", "name"))))
        quota = both.select("node", (half - F.col("over_inside") - F.col("m_right")
                                     + F.col("right_beyond")).alias("quota"))
        rows.append(stored(ranked.join(quota, "node").select(
            "node", *_JOB, F.when(F.col("meets"), F.col("rank") <= F.col("quota")).otherwise(
                F.col("done")).alias("done")), "beyond"))
        sums.append(stored(both.select("node", (F.col("m_left") + F.least(
            F.lit(half), F.col("over") + F.col("m_right"))).alias("m")), "sums"))

    # down: the true backlog (node, job) at the start of each node
    backlog = jobs.limit(0).select(F.lit(0).cast("long").alias("node"), *_JOB)
    for level in range(len(rows) - 2, -1, -1):
        half = size // 2
        first = (2 * F.col("node")).alias("node")
        middle = (F.col("node") * size + half)
        seen = rows[level].where("node % 2 = 0").select(F.expr("node div 2").alias("node"), *_JOB, "done")
        beyond_left = backlog.where(F.col("d") > middle)
        waiting = seen.where("done").drop("done").unionByName(beyond_left)
        used = sums[level].where("node % 2 = 0").select(F.expr("node div 2").alias("node"), F.col("m").alias("n")) \
            .union(seen.where("done").groupBy("node").agg((-F.count("*")).alias("n"))) \
            .union(backlog.where(F.col("d") <= middle).groupBy("node").agg(F.count("*").alias("n"))) \
            .groupBy("node").agg(F.sum("n").alias("used"))
        kept = waiting.withColumn("rank", F.row_number().over(by_priority)).join(used, "node", "left").where(
            F.col("rank") > half - F.coalesce("used", F.lit(0))).select("node", *_JOB)
        right = kept.unionByName(seen.where("NOT done").drop("done")).select(
            (2 * F.col("node") + 1).alias("node"), *_JOB)
        halves = backlog.select(first, *_JOB).unionByName(right)
        # a node can't do more than it has slots
        backlog = stored(halves.withColumn("rank", F.row_number().over(by_priority)).where(
            F.col("rank") <= half).drop("rank"), "backlog")
        size = half
    played = _leaf_jobs(jobs, backlog).select(F.explode(_played(F.col("jobs"), start)).alias("j"))
    return stored(played.select("j.name", "j.block", "j.slot"), "schedule")


def _placed(docs: DataFrame, weights: DataFrame | None, block_docs: int) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct) with block, slot and place."""
    sizes = shares(docs, weights)
    slots = schedule(jobs_of(sizes, block_docs))
    text = [F.coalesce(F.col("text").cast("string"), F.lit(""))] if "text" in docs.columns else []
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *text)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"),
                       _name(F.col("source")).alias("name"), hash60(key).alias("h"))
    bucket = F.shiftright("h", 60 - BUCKETS.bit_length() + 1)
    rows = rows.withColumn("bucket", bucket)
    before = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(rows.groupBy("name", "bucket").agg(F.count("*").alias("n")).select(
        "name", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), "n"), "starts")
    # the blocks of each range of hashes, with their slots
    first = F.expr(f"start div {block_docs}")
    wanted = starts.select("name", "bucket", "start", F.explode(F.sequence(
        first, F.expr(f"(start + n - 1) div {block_docs}"))).alias("block"))
    ranges = stored(wanted.join(slots, ["name", "block"]).groupBy("name", "bucket").agg(
        F.first("start").alias("start"), F.map_from_entries(F.collect_list(F.struct("block", "slot"))).alias(
            "slots")), "ranges")
    inside = Window.partitionBy("name", "bucket").orderBy("h", "id")
    # dealt by source and range for the ranking and the join alike
    ranked = rows.withColumn("rank", F.row_number().over(inside)).join(ranges.hint("merge"), ["name", "bucket"])
    at = F.col("start") + F.col("rank") - 1
    return ranked.withColumn("at", at).withColumn("block", F.expr(f"at div {block_docs}")).select(
        "row", "block", F.element_at("slots", F.col("block")).alias("slot"),
        (F.col("at") % block_docs).alias("place"))


def mix(docs: DataFrame, weights: DataFrame | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The rows of ``docs``, all columns, and their place: ``mix_block`` (block number in
    the source), ``mix_slot`` (place of the block in the mixture) and ``mix_place`` (place in
    the block). Ordered by slot and place the rows are the mixture. Columns of these
    names in ``docs`` are replaced."""
    placed = _placed(docs.drop("mix_block", "mix_slot", "mix_place"), weights, block_docs)
    return placed.select("row", *(F.col(c).alias(f"mix_{c}") for c in ("block", "slot", "place"))).select(
        "row.*", "mix_block", "mix_slot", "mix_place")


def mixture(docs: DataFrame, weights: DataFrame | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The rows and columns of ``docs`` in the order of the mixture."""
    return _placed(docs, weights, block_docs).orderBy("slot", "place").select("row.*")


def written_places(docs: DataFrame) -> DataFrame:
    """A ``mixture`` that was written as Parquet and is read again, with the places of its rows:
    ``mix_file`` (number of the part file) and ``mix_row`` (row in it). Sorted by the two, rows
    are in the order of the mixture, which reading alone doesn't keep."""
    return docs.select(
        "*", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("mix_file"),
        F.col("_metadata.row_index").alias("mix_row"))
