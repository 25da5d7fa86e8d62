"""Cell aggregation of the sales cube: one row per
(region, product_id, sale_month, num_month, sale_year).

Measures, as specified (rounded half up):

    avg_receipt           round(avg(sale_amount), 1)
    sum_amount            round(sum(sale_amount), 1) cast to long (truncates)
    count_sales           count(sale_date)  -- rows without a date count 0
    sum_quantity          sum(quantity)
    avg_receipt_quantity  round(avg(quantity), 1)

Amounts are summed exactly, whatever their decimals, and every rounding is one integer
division (``tillroll.functions.rounding``), so the result does not depend on
summation order. Two hidden columns carry the rounded means in tenths for the
roll-ups: ``_receipt10`` and ``_quantity10``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import DATE_PARTS_SQL
from tillroll.functions.rounding import (
    EXACT_TOTAL,
    exact_sums,
    half_up,
    tenths,
    toward_zero,
    total_tenths,
)
from tillroll.schemas import CELL_MEASURES, CUBE_KEYS

HIDDEN = ["_receipt10", "_quantity10"]

_RECEIPT10 = total_tenths("nullif(_n_amount, 0)")
_QUANTITY10 = half_up("sum_quantity * 10", "nullif(_n_quantity, 0)")


def with_date_parts(sales: DataFrame, date_col: str = "sale_date") -> DataFrame:
    return sales.withColumns({n: F.expr(e.format(d=date_col)) for n, e in DATE_PARTS_SQL.items()})


def cells_with_tenths(sales: DataFrame) -> DataFrame:
    """Cells with the five measures and the two hidden tenths columns.

    Rows are grouped by year and month number; the month name, a function of
    the month number, is formatted once per cell after the aggregation
    instead of once per sale (same groups, same values).
    """
    sums = sales.groupBy(
        "region", "product_id",
        F.expr("year(sale_date) AS sale_year"), F.expr("month(sale_date) AS num_month"),
    ).agg(
        *[F.expr(e).alias(n) for n, e in exact_sums(
            "sale_amount", sales.schema["sale_amount"].dataType).items()],
        F.expr("count(sale_amount) AS _n_amount"),
        F.expr("count(sale_date) AS count_sales"),
        F.expr("CAST(sum(quantity) AS BIGINT) AS sum_quantity"),
        F.expr("count(quantity) AS _n_quantity"),
    )
    for step in EXACT_TOTAL:
        sums = sums.withColumns({n: F.expr(e) for n, e in step.items()})
    sum10 = f"CASE WHEN _n_amount > 0 THEN {total_tenths('1')} END"
    return sums.selectExpr(
        "region", "product_id",
        "date_format(make_date(sale_year, num_month, 1), 'MMMM') AS sale_month",
        "num_month", "sale_year",
        f"{tenths(_RECEIPT10)} AS avg_receipt",
        f"{toward_zero(sum10, '10')} AS sum_amount",
        "count_sales",
        "sum_quantity",
        f"{tenths(_QUANTITY10)} AS avg_receipt_quantity",
        f"{_RECEIPT10} AS _receipt10",
        f"{_QUANTITY10} AS _quantity10",
    )


def cell_aggregate(sales: DataFrame) -> DataFrame:
    """The 10 cell columns: 5 keys, 5 measures."""
    return cells_with_tenths(sales).select(*CUBE_KEYS, *CELL_MEASURES)
