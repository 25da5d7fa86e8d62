"""Chart-ready and dashboard-ready results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.functions.text import bar_label, tick_label
from tillroll.operators.rollups import dimension_rollup

# Fixed values of the bar chart layout: axis head-room and label offset.
AXIS_HEADROOM = 1.18
LABEL_OFFSET = 0.01


def chart_labels(top: DataFrame, value: str) -> DataFrame:
    """Bar-chart data of a top-k result (at most k rows, so the un-partitioned
    window below sees at most k rows): rank, position from the bottom, the
    id as text, the value label, the value as the axis shows it, the axis
    limit and the label position."""
    order = Window.orderBy(F.col(value).desc_nulls_last(), F.col("product_id").asc())
    whole = Window.partitionBy()
    max_value = F.max(value).over(whole)
    rank = F.row_number().over(order)
    return top.select(
        "product_id",
        value,
        rank.alias("rank"),
        (F.count(F.lit(1)).over(whole) + 1 - rank).alias("display_pos"),
        F.col("product_id").cast("string").alias("product_label"),
        bar_label(F.col(value)).alias("value_label"),
        tick_label(F.col(value)).alias("axis_label"),
        (F.coalesce(max_value, F.lit(1)) * F.lit(AXIS_HEADROOM)).alias("axis_max"),
        (F.col(value) + max_value * F.lit(LABEL_OFFSET)).alias("label_x"),
    )


def dashboard_region(cells: DataFrame) -> DataFrame:
    """Sales by region: the five region roll-ups."""
    return dimension_rollup(cells, "region")


def dashboard_product(cells: DataFrame) -> DataFrame:
    """Sales by product: the five product roll-ups."""
    return dimension_rollup(cells, "product_id")


def dashboard_period(cells: DataFrame) -> DataFrame:
    """Sales by calendar month: the five month roll-ups, with the month number."""
    return dimension_rollup(cells, "month_year", {"num_month": "max(num_month)"})


def dashboard_query(spark: SparkSession, views: dict[str, DataFrame], sql: str,
                    **params) -> DataFrame:
    """Run templated SQL over named views, with named parameter markers
    (``:region``) bound from ``params``; values are never pasted into the
    text."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=params or None)
