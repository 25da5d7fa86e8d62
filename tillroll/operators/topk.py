"""Top-k products of a month, read from the cube."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import as_date_lit, month_name, months_back
from tillroll.operators.rollups import dimension_rollup

# metric name -> (cube column, output alias)
METRICS = {
    "receipt": ("avg_receipt_product_id", "avg_receipt"),
    "amount": ("sum_amount_product_id", "amount"),
}


def month_filter(as_of: _dt.date | str | None, months: int = 0, shift_year: bool = False):
    """Predicate on the cube's calendar keys for ``as_of - months``
    (``as_of=None``: today).

    As specified, the year is that of ``as_of`` even when the month steps
    back over New Year (so "previous month" in January finds nothing);
    ``shift_year=True`` takes the year of the shifted date instead. The
    month number is added to the name so stored data sorted or partitioned by
    (sale_year, num_month) can be pruned; name and number are one-to-one.
    """
    day = as_date_lit(as_of)
    target = months_back(day, months) if months else day
    year = F.year(target) if shift_year else F.year(day)
    return ((F.col("sale_month") == month_name(target))
            & (F.col("num_month") == F.month(target))
            & (F.col("sale_year") == year))


def month_products(cube: DataFrame, metric: str, as_of, months: int = 0,
                   shift_year: bool = False) -> DataFrame:
    """Distinct (product_id, metric) of products sold in the month. The
    metric is the product's all-time roll-up, as specified."""
    column, alias = METRICS[metric]
    return (cube.where(month_filter(as_of, months, shift_year))
            .select("product_id", F.col(column).alias(alias))
            .distinct())


def top_products(cube: DataFrame, metric: str, as_of, months: int = 0, k: int = 10,
                 shift_year: bool = False) -> DataFrame:
    """The k products with the highest metric, ties broken by product_id."""
    _, alias = METRICS[metric]
    return (month_products(cube, metric, as_of, months, shift_year)
            .orderBy(F.col(alias).desc_nulls_last(), F.col("product_id").asc())
            .limit(k))


def top_products_from_cells(cells: DataFrame, metric: str, as_of, months: int = 0, k: int = 10,
                            shift_year: bool = False) -> DataFrame:
    """Same rows as ``top_products(sales_cube(...), ...)`` in one pass over
    the cells, for when the cube is not stored: one aggregate per product
    gives the all-time roll-up and whether the product sold in the month, so
    the cells are not scanned twice and nothing is joined back.
    ``cells`` must carry the hidden tenths columns (``cells_with_tenths``).
    """
    column, alias = METRICS[metric]
    sold = F.max(month_filter(as_of, months, shift_year).cast("int"))
    per_product = dimension_rollup(cells, "product_id", {"_sold": sold})
    return (per_product.where(F.col("_sold") == 1)
            .select("product_id", F.col(column).alias(alias))
            .orderBy(F.col(alias).desc_nulls_last(), F.col("product_id").asc())
            .limit(k))


# The same query as SQL over a stored cube, for SQL users; the table and the
# day are bound as parameters, the month offset and k are integers.
TOP_SQL = """
SELECT DISTINCT product_id, {column} AS {alias}
FROM IDENTIFIER(:cube)
WHERE sale_month = date_format({target}, 'MMMM')
  AND num_month = month({target})
  AND sale_year = year({year_of})
ORDER BY {alias} DESC, product_id
LIMIT {k}
"""


def top_products_sql(spark: SparkSession, cube_table: str, metric: str, as_of=None,
                     months: int = 0, k: int = 10, shift_year: bool = False) -> DataFrame:
    """``top_products`` over a stored cube, written as SQL (``as_of=None``:
    the session's ``current_date()``)."""
    column, alias = METRICS[metric]
    args = {"cube": cube_table}
    if as_of is None:
        day = "current_date()"
    else:
        day = ":as_of"
        args["as_of"] = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(as_of)
    target = f"add_months({day}, -{int(months)})"
    sql = TOP_SQL.format(column=column, alias=alias, target=target, k=int(k),
                         year_of=target if shift_year else day)
    return spark.sql(sql, args=args)
