"""Column lists and type contracts of the sales fact and the sales cube."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and orders that must equal the reference's tables.
SALES_COLUMNS = [
    "sale_id", "customer_id", "product_id", "quantity",
    "sale_date", "price_product", "sale_amount", "region",
]

CUBE_KEYS = ["region", "product_id", "sale_month", "num_month", "sale_year"]

CELL_MEASURES = [
    "avg_receipt", "sum_amount", "count_sales", "sum_quantity", "avg_receipt_quantity",
]

# Roll-up dimensions: name used in the column suffix -> grouping columns.
DIMENSIONS = {
    "region": ["region"],
    "month_year": ["sale_month", "sale_year"],
    "product_id": ["product_id"],
}


def rollup_columns(dim: str) -> list[str]:
    """The five roll-up column names of a dimension, e.g. ``sum_amount_region``."""
    return [f"{m}_{dim}" for m in CELL_MEASURES]


CUBE_COLUMNS = CUBE_KEYS + CELL_MEASURES + [
    c for dim in DIMENSIONS for c in rollup_columns(dim)
]

WAREHOUSE_COLUMNS = CUBE_COLUMNS + ["import_date"]

# Raw sales rows as read from CSV (explicit; inference stays an option).
SALES_SCHEMA = T.StructType([
    T.StructField("sale_id", T.LongType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("sale_date", T.DateType()),
    T.StructField("price_product", T.DoubleType()),
    T.StructField("sale_amount", T.DoubleType()),
    T.StructField("region", T.StringType()),
])

REGION_MAX_LENGTH = 10

# Store types of the row store (relational DDL).
ROWSTORE_SALES_TYPES = {
    "sale_id": "bigint",
    "customer_id": "int",
    "product_id": "int",
    "quantity": "int",
    "sale_date": "date",
    "price_product": "decimal(10,2)",
    "sale_amount": "decimal(12,2)",
    "region": "varchar(10)",
}


def _measure_type(measure: str, store: str) -> str:
    """Store type of a cell measure and of its roll-ups."""
    if measure == "avg_receipt":
        return "decimal(12,1)" if store == "rowstore" else "double"
    if measure == "avg_receipt_quantity":
        return "decimal(6,1)" if store == "rowstore" else "double"
    return "bigint"


def cube_types(store: str) -> dict[str, str]:
    """Column -> SQL type of the cube in ``store`` ('rowstore' or 'warehouse')."""
    rowstore = store == "rowstore"
    types = {"region": "varchar(10)" if rowstore else "string", "product_id": "int",
             "sale_month": "varchar(20)" if rowstore else "string",
             "num_month": "int", "sale_year": "int"}
    for measure in CELL_MEASURES:
        types[measure] = _measure_type(measure, store)
    for dim in DIMENSIONS:
        for measure in CELL_MEASURES:
            types[f"{measure}_{dim}"] = _measure_type(measure, store)
    types = {c: types[c] for c in CUBE_COLUMNS}
    if store == "warehouse":
        types["import_date"] = "date"
    return types


def value_type(sql_type: str) -> str:
    """The type of a column's values: a length limit belongs to the table alone, whose writer
    checks it."""
    return "string" if sql_type.startswith("varchar") else sql_type


def ddl(types: dict[str, str]) -> str:
    """Column list of a CREATE / ALTER TABLE statement: ``name type, ...``."""
    return ", ".join(f"{c} {t}" for c, t in types.items())
