"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll import session

#: The white space that separates words, as a Java/RE2 class.
WHITE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back (``tillroll.session.stored``), in the folder of the
    ``scratch`` block that runs, by default the application's below ``spark.checkpoint.dir``."""
    return session.stored(df, name, _SCRATCH.get())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside the block go when it ends; a result that reads them must be
    written by then."""
    folder = f"{session.shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        session.remove_stored(spark, folder)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id's decimal text leaves remainder ``fold``; a null
    id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int, fold: int, max_rows: int,
                    max_chars: int) -> DataFrame:
    """(doc_id, label, text, h) of training documents: ids of ``labels`` (doc_id, label) outside the
    held-out fold, those whose ids hash smallest, at most ``max_rows`` of them and ``max_chars``
    characters together. Every id stands once: of several labels the largest counts, of several
    texts the one of smallest md5. ``h`` gives their order."""
    inside = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold)
    marked = labels.where(F.col("label").isNotNull() & inside).groupBy("doc_id").agg(F.max("label").alias("label"))
    usable = docs.where(inside & F.col("text").isNotNull()).select(
        "doc_id", F.col("text").cast("string").alias("text"))
    n = marked.count()
    h = F.xxhash64("doc_id")
    if n > 2 * max_rows:  # leaves well over max_rows ids to the sort
        marked = marked.where(F.shiftrightunsigned(h, 33) < int((1 << 31) * 2.0 * max_rows / n))
    content = F.md5(F.col("text").cast("binary"))
    # digests meet the labels; texts only the chosen ids
    sizes = usable.select("doc_id", content.alias("which"), F.length("text").alias("chars"))
    sized = sizes.join(marked, "doc_id").groupBy("doc_id", "label").agg(
        F.min(F.struct("which", "chars")).alias("w")).select("doc_id", "label", "w.which", "w.chars")
    chosen = sized.orderBy(h, "doc_id").limit(max_rows).withColumn("h", h)
    before = Window.orderBy("h", "doc_id")  # max_rows narrow rows at most
    chosen = stored(chosen.withColumn("so_far", F.sum("chars").over(before)).where(
        F.col("so_far") <= max_chars).drop("so_far", "chars"), "train-ids")
    found = usable.join(F.broadcast(chosen), "doc_id").where(content == F.col("which"))
    return found.select("doc_id", "label", "text", "h").dropDuplicates(["doc_id"])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (Catalyst would copy the expression)."""
    return F.transform(F.array(value), body)[0]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into pieces of at most ``rows`` rows, without copying."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def hash60(text: Column) -> Column:
    """60 bits of a text's md5 as a long (the same in any SQL engine)."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


class WordCache(dict):
    """Results of ``compute`` for the keys met lately, at most twice ``size`` of them: when
    ``size`` are held they become the older half, from which a hit takes its key back."""

    def __init__(self, compute: Callable, size: int):
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value
