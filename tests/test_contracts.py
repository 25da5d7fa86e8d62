"""Store contracts: types, primary key, region length, schema evolution."""

import datetime as dt
from decimal import Decimal

import pytest

from tillroll.operators import contracts
from tillroll.plans.cube import sales_cube
from tillroll.schemas import CUBE_COLUMNS, SALES_SCHEMA, WAREHOUSE_COLUMNS, cube_types


def _sales(spark, rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def test_sales_contract_types_and_region_check(spark):
    df = _sales(spark, [(1, 2, 3, 4, dt.date(2024, 1, 2), 10.335, 41.34, "MIDDLE EAST"),
                        (2, 2, 3, 4, dt.date(2024, 1, 2), 10.33, 41.32, "North")])
    out = {r.sale_id: r for r in contracts.sales_contract(df).collect()}
    assert dict(contracts.sales_contract(df).dtypes)["price_product"] == "decimal(10,2)"
    assert out[2].price_product == Decimal("10.33")
    assert out[1].region_fits is False and out[2].region_fits is True


def test_pk_violations(spark):
    df = _sales(spark, [(1, 1, 1, 1, None, 1.0, 1.0, "a"), (1, 2, 1, 1, None, 1.0, 1.0, "a"),
                        (2, 1, 1, 1, None, 1.0, 1.0, "a"), (None, 1, 1, 1, None, 1.0, 1.0, "a")])
    got = {(r.sale_id, r.n) for r in contracts.pk_violations(df).collect()}
    assert got == {(1, 2), (None, 1)}


def test_rowstore_and_warehouse_cube(spark):
    df = _sales(spark, [(1, 1, 7, 3, dt.date(2024, 5, 1), 1.0, 12.34, "West")])
    cube = sales_cube(df)
    row = contracts.rowstore_cube(cube)
    assert row.columns == [*CUBE_COLUMNS, "region_fits"]
    assert dict(row.dtypes)["avg_receipt"] == "decimal(12,1)"
    assert dict(row.dtypes)["avg_receipt_quantity_region"] == "decimal(6,1)"
    wh = contracts.warehouse_cube(cube, dt.date(2024, 6, 1))
    assert wh.columns == WAREHOUSE_COLUMNS
    assert wh.first().import_date == dt.date(2024, 6, 1)
    assert dict(wh.dtypes) == cube_types("warehouse")


def test_decimal_overflow_raises_under_ansi(spark):
    df = spark.createDataFrame([(123456.7,)], "x double")
    with pytest.raises(Exception):
        contracts.cast_to(df, {"x": "decimal(6,1)"}).collect()


def test_union_evolved(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(2, "b", 3.5)], "k int, v string, extra double")
    out = sorted(contracts.union_evolved(old, new).collect())
    assert [tuple(r) for r in out] == [(1, "a", None), (2, "b", 3.5)]


def test_create_and_add_columns(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS contracts_t")
    t = "contracts_t.evolving"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    contracts.create_table_if_absent(spark, t, {"k": "int", "a": "bigint"})
    contracts.create_table_if_absent(spark, t, {"k": "int", "a": "bigint"})  # no-op
    added = contracts.add_missing_columns(spark, t, {"k": "int", "a": "bigint", "b": "double"})
    assert added == ["b"]
    assert spark.read.table(t).columns == ["k", "a", "b"]
    assert contracts.add_missing_columns(spark, t, {"k": "int", "b": "double"}) == []
