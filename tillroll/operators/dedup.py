"""Full-row de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import stored

#: Above this many bytes of repeated digests whole rows are dealt at once.
MAX_REPEATED, DIGEST_BYTES = 64 << 20, 8


def dedup_full_row(df: DataFrame) -> DataFrame:
    """Drop rows that equal another row in every column.

    Planned as a partial aggregate on all columns before the shuffle and a
    final one after it: exact copies collapse inside each map task, so even a
    row repeated a billion times ships once per task, and the shuffle hash
    covers every column, so no single business key can skew it.
    """
    return df.dropDuplicates()


def row_digest(df: DataFrame) -> list[Column]:
    """64 bits of a row; nulls and empty texts differ by their places."""
    places = F.concat_ws(",", *(F.when(F.col(c).isNull(), F.lit(str(i)))
                                for i, c in enumerate(df.columns)))
    return [F.xxhash64(*df.columns, places)]


def dedup_by_digest(df: DataFrame, digest=row_digest, max_repeated: int = MAX_REPEATED) -> DataFrame:
    """``dedup_full_row`` of wide rows of which few are copies, from a stored table (it is read
    twice). Only digests are shuffled; rows whose digest stands once pass as they are,
    and the others are compared in full, so unlike rows of one digest stay apart, whatever the
    digest (``digest`` gives its columns). With more repeated digests than ``max_repeated`` bytes
    hold, whole rows are dealt at once instead. One job runs when it is called."""
    names = [f"_digest{i}" for i in range(len(digest(df)))]
    marked = df.select("*", *(c.alias(n) for c, n in zip(digest(df), names)))
    repeated = stored(marked.groupBy(*names).agg(F.count("*").alias("_n")).where("_n > 1").select(*names),
                      "repeated-digests")
    n = repeated.count()
    if not n:
        return df
    if DIGEST_BYTES * len(names) * n > max_repeated:
        return dedup_full_row(df)
    repeated = F.broadcast(repeated)  # max_repeated bytes at most, just counted
    once = marked.join(repeated, names, "left_anti")
    again = marked.join(repeated, names, "left_semi")
    return once.select(*df.columns).unionAll(dedup_full_row(again.select(*df.columns)))
