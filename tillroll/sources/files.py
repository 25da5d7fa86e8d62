"""Readers for raw sales rows: CSV, Parquet, catalog tables and JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import SALES_SCHEMA
from tillroll.session import stored

#: Column of a row that has too few or too many cells.
LINE = "_line"


def read_sales_csv(spark: SparkSession, path: str, infer_schema: bool = False,
                   **options) -> DataFrame:
    """Raw sales CSV with a header. The explicit schema avoids the extra pass
    that inference makes; ``infer_schema=True`` reproduces the inferred types.

    Reading is strict: a header that differs from the schema, or a cell that doesn't
    parse, fails the read (``mode`` and ``enforceSchema`` in ``options`` override it).
    """
    reader = spark.read.option("header", True)
    if infer_schema:
        return reader.option("inferSchema", True).options(**options).csv(path)
    strict = {"enforceSchema": "false", "mode": "FAILFAST"} | options
    return reader.schema(SALES_SCHEMA).options(**strict).csv(path)


def typed_cell(cell: Column, kind: T.DataType) -> Column:
    """A cell's text as its column's type; null where the text isn't one. Dates are written
    ``2024-01-31``."""
    if isinstance(kind, T.DateType):
        return F.try_to_timestamp(cell, F.lit("yyyy-MM-dd")).cast("date")
    return cell.try_cast(kind)


def read_sales_csv_rejects(spark: SparkSession, path: str, schema: T.StructType = SALES_SCHEMA,
                           **options) -> tuple[DataFrame, DataFrame]:
    """Raw sales CSV with a header as (good rows, rejects), for files that strict reading refuses.

    The source is read once: cells come as text, are typed, and the rows are stored with the
    reasons against them. Good rows have every cell of its type or empty (null), in the
    types of ``schema``. Rejects have ``file``, ``reasons`` (array of ``column: text is no
    type``, or ``wrong number of cells``) and ``cells`` (the texts of the row; of a row with
    a wrong number of cells, its whole line). A header that differs still fails the read.
    """
    names = schema.fieldNames()
    texts = T.StructType([T.StructField(n, T.StringType()) for n in [*names, LINE]])
    rows = spark.read.option("header", True).schema(texts).options(
        **({"enforceSchema": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE} | options)
    ).csv(path).select("*", F.col("_metadata.file_path").alias("_file"))
    cells = {f.name: typed_cell(F.trim(F.col(f.name)), f.dataType) for f in schema.fields}
    bad = [F.when(F.col(f.name).isNotNull() & cells[f.name].isNull(), F.concat(
        F.lit(f"{f.name}: "), F.col(f.name), F.lit(f" is no {f.dataType.simpleString()}")))
        for f in schema.fields]
    reasons = F.when(F.col(LINE).isNotNull(), F.array(F.lit("wrong number of cells"))).otherwise(
        F.array_compact(F.array(*bad)))
    read = stored(rows.select(
        F.col("_file").alias("file"), reasons.alias("reasons"),
        F.when(F.col(LINE).isNotNull(), F.array(LINE)).otherwise(F.array(*names)).alias("cells"),
        F.struct(*(c.alias(n) for n, c in cells.items())).alias("row")), "csv")
    good = read.where(F.size("reasons") == 0).select("row.*")
    return good, read.where(F.size("reasons") > 0).select("file", "reasons", "cells")


def read_sales(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """Sales rows from a path (``parquet``/``csv``/``orc``) or a table (``table``)."""
    if fmt == "table":
        return spark.read.options(**options).table(source)
    if fmt == "csv":
        return read_sales_csv(spark, source, options.pop("infer_schema", False), **options)
    return spark.read.options(**options).format(fmt).load(source)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A database table or query. Give ``partition_column`` and its bounds to
    read it with ``num_partitions`` parallel range queries instead of one."""
    properties = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=properties)
