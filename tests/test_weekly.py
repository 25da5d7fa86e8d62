"""The weekly refresh end to end on generated rows."""

import datetime as dt

import pytest

from tillroll.plans.weekly import ContractError, run_weekly
from tillroll.plans.cube import sales_cube
from tillroll.schemas import WAREHOUSE_COLUMNS
from tillroll.sources.generator import generate_sales, quotas


def test_weekly_refresh(spark):
    n = 4000
    raw = generate_sales(spark, n, dt.date(2025, 3, 4))
    report = run_weekly(spark, raw, "weekly_t", dt.date(2025, 3, 4)).first()
    total = sum(quotas(n))
    sales = spark.read.table("weekly_t.sales")
    cube = spark.read.table("weekly_t.sales_aggregated")
    wh = spark.read.table("weekly_t.sales_aggregated_wh")
    assert sales.count() == total
    assert cube.count() == wh.count() == sales_cube(raw).count()
    assert wh.columns == WAREHOUSE_COLUMNS
    assert wh.agg({"import_date": "max"}).first()[0] == dt.date(2025, 3, 4)
    assert report.total_rows == total + 2 * cube.count()
    assert report.latest_import == dt.date(2025, 3, 4)
    assert f"`sales`: `{total:,}`" in report.report
    # statistics are computed after each switch
    from tillroll.operators.monitoring import catalog_row_counts, estimated_row_counts
    exact = catalog_row_counts(spark, "x", "weekly_t").collect()
    assert estimated_row_counts(spark, "x", "weekly_t").collect() == exact
    # a second run replaces, never appends
    run_weekly(spark, raw, "weekly_t", dt.date(2025, 3, 4)).first()
    assert spark.read.table("weekly_t.sales").count() == total


def test_weekly_refuses_duplicate_keys(spark):
    raw = generate_sales(spark, 1000, dt.date(2025, 3, 4))
    with pytest.raises(ContractError):
        run_weekly(spark, raw.unionAll(raw.limit(3)), "weekly_dup")


def test_topk_on_stored_cube_prunes(spark):
    from tillroll.operators.topk import top_products
    raw = generate_sales(spark, 3000, dt.date(2025, 3, 4))
    run_weekly(spark, raw, "weekly_topk", dt.date(2025, 3, 4)).first()
    stored = spark.read.table("weekly_topk.sales_aggregated_wh")
    top = top_products(stored, "amount", dt.date(2025, 3, 4), months=1)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = top._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(sale_year,2025)" in plan and "EqualTo(num_month,2)" in plan
    assert "TakeOrderedAndProject" in plan
    expected = top_products(sales_cube(raw), "amount", dt.date(2025, 3, 4), months=1)
    assert [tuple(r) for r in top.collect()] == [tuple(r) for r in expected.collect()]
    assert top.count() == 10
    from tillroll.operators.topk import top_products_sql
    for metric in ("receipt", "amount"):
        for months in (0, 1):
            a = top_products(stored, metric, dt.date(2025, 3, 4), months=months).collect()
            b = top_products_sql(spark, "weekly_topk.sales_aggregated_wh", metric,
                                 dt.date(2025, 3, 4), months=months).collect()
            assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_command_line(spark, capsys):
    from tillroll.plans.weekly import main
    main(["--generate", "2000", "--database", "weekly_cli", "--as-of", "2025-02-01"])
    out = capsys.readouterr().out
    assert "`sales`: `2,000`" in out and "sales_aggregated_wh" in out


def test_two_stores_report_per_store(spark):
    raw = generate_sales(spark, 2000, dt.date(2025, 3, 4))
    rows = {r.source: r for r in run_weekly(spark, raw, "weekly_rs", dt.date(2025, 3, 4),
                                            warehouse_database="weekly_wh").collect()}
    assert set(rows) == {"rowstore", "warehouse"}
    n_cube = spark.read.table("weekly_rs.sales_aggregated").count()
    assert rows["rowstore"].total_rows == 2000 + n_cube
    assert rows["warehouse"].total_rows == n_cube
    assert "sales_aggregated_wh" in rows["warehouse"].report
    assert "sales_aggregated_wh" not in rows["rowstore"].report
