"""Roll-ups of the cell measures by region, by month and by product.

The reference defines each roll-up as an aggregate over a whole window
partition (no ORDER BY, no frame) of the cells. A window partition by region
would put all cells of one region -- possibly a third of the cube -- into one
task. The same values come from an aggregate per dimension value joined back to the
cells on that value.

Two steps keep the cells from being dealt by region or month. First the cells are stored, and
one pass over them gives the roll-ups of all dimensions (grouping sets: partial sums before
the shuffle, so no group is ever gathered in one place), each stored in a folder of its own.
Then the stored tables are joined: the planner reads their bytes from the files, so a
small roll-up is broadcast before any cell is shuffled. A roll-up beyond the broadcast
threshold is joined by sort-merge on its own key, which has one row there.

Means of means, as specified: ``avg_receipt_<dim>`` is the unweighted mean of
the cells' rounded ``avg_receipt``, rounded again; likewise for quantity.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.rounding import mean_tenths, tenths
from tillroll.schemas import CELL_MEASURES, DIMENSIONS
from tillroll.session import file_system, shared_folder

#: Keys of the dimensions in the order of their bits in ``grouping_id``, the first the highest.
KEYS = ["region", "product_id", "sale_month", "sale_year"]
#: The grand total, a dimension without keys.
TOTAL = "total"


def _sums(suffix: str = "") -> list:
    return [F.expr(e).alias(n) for n, e in {
        "_r10": "sum(_receipt10)",
        "_nr": "count(_receipt10)",
        f"sum_amount{suffix}": "sum(sum_amount)",
        f"count_sales{suffix}": "sum(count_sales)",
        f"sum_quantity{suffix}": "sum(sum_quantity)",
        "_q10": "sum(_quantity10)",
        "_nq": "count(_quantity10)",
    }.items()]


def _measures(suffix: str = "") -> list[str]:
    return [
        f"{tenths(mean_tenths('_r10', '_nr'))} AS avg_receipt{suffix}",
        f"sum_amount{suffix}",
        f"count_sales{suffix}",
        f"sum_quantity{suffix}",
        f"{tenths(mean_tenths('_q10', '_nq'))} AS avg_receipt_quantity{suffix}",
    ]


def dimension_rollup(cells: DataFrame, dim: str, extra_keys: dict[str, str] | None = None
                     ) -> DataFrame:
    """One row per value of ``dim`` with its five roll-up measures.

    ``cells`` must carry the hidden tenths columns (``cells_with_tenths``).
    ``extra_keys`` maps names to further aggregates (SQL text or Columns),
    e.g. ``max(num_month)`` of a month name.
    """
    keys = DIMENSIONS[dim]
    extras = list((extra_keys or {}).items())
    sums = cells.groupBy(*keys).agg(
        *[(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in extras], *_sums(f"_{dim}"))
    return sums.selectExpr(*keys, *[n for n, _ in extras], *_measures(f"_{dim}"))


def grouped_rollups(cells: DataFrame, dims: list[str]) -> DataFrame:
    """The roll-ups of several dimensions (and ``TOTAL``) from one pass over the cells:
    ``dim``, its keys (null where they aren't of that dimension), ``num_month`` of a month and the
    five measures."""
    sets = {d: DIMENSIONS.get(d, []) for d in dims}
    used = [k for k in KEYS if any(k in keys for keys in sets.values())]
    bits = {d: sum(1 << (len(used) - 1 - i) for i, k in enumerate(used) if k not in keys)
            for d, keys in sets.items()}
    grouped = cells.groupingSets([[F.col(k) for k in keys] for keys in sets.values()],
                                 *map(F.col, used)).agg(
        F.grouping_id().alias("_set"), F.max("num_month").alias("num_month"), *_sums())
    named = " ".join(f"WHEN {bit} THEN '{d}'" for d, bit in bits.items())
    month = bits.get("month_year", -1)
    return grouped.selectExpr(
        f"CASE _set {named} END AS dim",
        *(k if k in used else f"CAST(NULL AS {cells.schema[k].dataType.simpleString()}) AS {k}"
          for k in KEYS),
        f"CASE WHEN _set = {month} THEN num_month END AS num_month", *_measures())


def stored_rollups(cells: DataFrame, dims: list[str], folder: str | None = None
                   ) -> dict[str, DataFrame]:
    """The roll-up of each dimension, stored: the planner knows the bytes of each."""
    spark = cells.sparkSession
    path = f"{folder or shared_folder(spark)}/rollups-{uuid.uuid4().hex}"
    grouped = grouped_rollups(cells, dims)
    schema = grouped.drop("dim").schema
    grouped.write.partitionBy("dim").parquet(path)
    found = {}
    for dim in dims:
        fs, at = file_system(spark, f"{path}/dim={dim}")
        rows = (spark.read.schema(schema).parquet(f"{path}/dim={dim}") if fs.exists(at)
                else spark.createDataFrame([], schema))  # no cells, no groups
        found[dim] = rows.select(*DIMENSIONS.get(dim, []),
                                 *(F.col(m).alias(f"{m}_{dim}") for m in CELL_MEASURES))
    return found


def join_rollup(cells: DataFrame, rollup: DataFrame, dim: str) -> DataFrame:
    """Attach a dimension roll-up to every cell. Null-safe on the keys: a
    sale without a date forms a cell whose month and year are null."""
    keys = DIMENSIONS[dim]
    right = rollup.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    cond = F.expr(" AND ".join(f"{k} <=> _k_{k}" for k in keys))
    return cells.join(right, cond, "left").drop(*[f"_k_{k}" for k in keys])


def add_rollups(cells: DataFrame, dims: list[str] | None = None, folder: str | None = None
                ) -> DataFrame:
    """Cells (a stored table, as they are read twice) plus the five roll-up columns of each
    dimension in ``dims``. Runs one job when called."""
    out = cells
    for dim, rollup in stored_rollups(cells, dims or list(DIMENSIONS), folder).items():
        out = join_rollup(out, rollup, dim)
    return out
