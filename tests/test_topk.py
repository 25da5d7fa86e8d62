"""Top-k queries: month selection, the year quirk, ties, small inputs."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators.presentation import chart_labels
from tillroll.operators.topk import month_products, top_products
from tillroll.plans.cube import sales_cube
from tillroll.schemas import SALES_SCHEMA


def _sales(spark, rows):
    return spark.createDataFrame(
        [(i + 1, 1, p, q, d, 1.0, a, "North") for i, (p, q, d, a) in enumerate(rows)],
        SALES_SCHEMA)


def test_previous_month_in_january_is_empty_as_specified(spark):
    rows = [(1, 1, dt.date(2000, 12, 10), 5.0), (2, 1, dt.date(2001, 1, 5), 7.0)]
    cube = sales_cube(_sales(spark, rows), ["product_id"])
    prev = top_products(cube, "amount", dt.date(2001, 1, 15), months=1)
    assert prev.isEmpty()
    repaired = top_products(cube, "amount", dt.date(2001, 1, 15), months=1, shift_year=True)
    assert [r.product_id for r in repaired.collect()] == [1]


def test_month_back_clamps_to_month_end(spark):
    rows = [(1, 1, dt.date(2025, 2, 28), 5.0), (2, 1, dt.date(2025, 3, 3), 7.0)]
    cube = sales_cube(_sales(spark, rows), ["product_id"])
    prev = top_products(cube, "amount", dt.date(2025, 3, 31), months=1)
    assert [r.product_id for r in prev.collect()] == [1]


def test_metric_is_all_time_and_ties_break_by_product(spark):
    rows = [(p, 1, dt.date(2001, 10, 1), 10.0) for p in range(1, 13)]
    rows += [(5, 1, dt.date(2001, 3, 1), 10.0)]  # product 5 has more all-time sales
    cube = sales_cube(_sales(spark, rows), ["product_id"])
    top = top_products(cube, "amount", dt.date(2001, 10, 15), k=10).collect()
    assert [r.product_id for r in top] == [5, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert top[0].amount == 20 and top[1].amount == 10


def test_fewer_products_than_k(spark):
    rows = [(3, 2, dt.date(2001, 10, 2), 4.0), (4, 1, dt.date(2001, 10, 3), 9.0)]
    cube = sales_cube(_sales(spark, rows), ["product_id"])
    top = top_products(cube, "receipt", dt.date(2001, 10, 15)).collect()
    assert [(r.product_id, r.avg_receipt) for r in top] == [(4, 9.0), (3, 4.0)]


def test_distinct_is_one_row_per_product(spark):
    rows = [(1, 1, dt.date(2001, 10, 1), 2.0), (1, 1, dt.date(2001, 10, 9), 4.0)]
    cube = sales_cube(_sales(spark, rows).withColumn(
        "region", F.when(F.col("sale_id") == 1, "North").otherwise("South")), ["product_id"])
    assert cube.count() == 2
    assert month_products(cube, "receipt", dt.date(2001, 10, 15)).count() == 1


def test_chart_labels(spark):
    rows = [(1, 1, dt.date(2001, 10, 1), 1234.5), (2, 1, dt.date(2001, 10, 1), 2500000.0)]
    cube = sales_cube(_sales(spark, rows), ["product_id"])
    top = top_products(cube, "amount", dt.date(2001, 10, 15))
    labels = {r.product_id: r for r in chart_labels(top, "amount").collect()}
    assert labels[2].rank == 1 and labels[2].display_pos == 2
    assert labels[1].rank == 2 and labels[1].display_pos == 1
    assert labels[2].value_label == "2.50M"
    assert labels[1].value_label == "1,234.0"
    assert labels[2].axis_label == "2.5M" and labels[1].axis_label == "1,234"
    assert labels[1].product_label == "1"
    assert abs(labels[1].axis_max - 2500000 * 1.18) < 1e-6
    assert abs(labels[1].label_x - (1234 + 2500000 * 0.01)) < 1e-6


def test_empty_cube(spark):
    cube = sales_cube(_sales(spark, []), ["product_id"])
    assert top_products(cube, "receipt", dt.date(2001, 10, 15)).isEmpty()


def test_one_pass_form_equals_cube_form(spark, sf_small):
    from tillroll.operators.cells import cells_with_tenths
    from tillroll.operators.dedup import dedup_full_row
    from tillroll.operators.topk import top_products_from_cells
    from tillroll.sources.testdata import sales_fact
    fact = sales_fact(spark, sf_small)
    cube = sales_cube(fact, ["product_id"])
    cells = cells_with_tenths(dedup_full_row(fact))
    for metric in ("receipt", "amount"):
        for months, shift in ((0, False), (1, False), (1, True), (13, False)):
            for as_of in (dt.date(2001, 10, 15), dt.date(1998, 1, 20)):
                a = [tuple(r) for r in top_products(cube, metric, as_of, months, 10, shift).collect()]
                b = [tuple(r) for r in top_products_from_cells(cells, metric, as_of, months, 10,
                                                               shift).collect()]
                assert a == b, (metric, months, shift, as_of)


def test_default_day_is_today(spark):
    today = spark.range(1).select(F.current_date()).first()[0]  # the session's today
    cube = sales_cube(_sales(spark, [(1, 1, today, 3.0), (2, 1, today.replace(day=1), 5.0)]),
                      ["product_id"])
    assert [r.product_id for r in top_products(cube, "amount", None).collect()] == [2, 1]


def test_sql_form_defaults_to_today(spark):
    from tillroll.operators.topk import top_products_sql
    today = spark.range(1).select(F.current_date()).first()[0]
    cube = sales_cube(_sales(spark, [(1, 1, today, 3.0), (2, 1, today.replace(day=1), 5.0)]))
    cube.createOrReplaceTempView("topk_today_cube")
    got = top_products_sql(spark, "topk_today_cube", "amount").collect()
    assert [r.product_id for r in got] == [2, 1]
    assert [tuple(r) for r in got] == [tuple(r) for r in top_products(cube, "amount", None).collect()]
