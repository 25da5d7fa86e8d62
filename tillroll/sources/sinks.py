"""Sinks: CSV and Parquet files, catalog tables (full refresh), JDBC."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.contracts import add_missing_columns, create_table_if_absent
from tillroll.schemas import CUBE_COLUMNS, SALES_COLUMNS, cube_types, ddl, value_type
from tillroll.session import file_system


def write_sales_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Raw sales as CSV with a header, in the fixed column order. Written by
    the executors, one file per partition; nothing passes through the driver."""
    df.select(*(columns or SALES_COLUMNS)).write.mode("overwrite") \
        .option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def clustered(df: DataFrame, cluster_by: list[str] | None, num_partitions: int | None = None
              ) -> DataFrame:
    """Range-partition and sort by ``cluster_by`` so each file covers a narrow
    key range: readers filtering on those keys skip whole files and row
    groups by their min/max statistics."""
    if not cluster_by:
        return df
    ranged = (df.repartitionByRange(num_partitions, *cluster_by) if num_partitions
              else df.repartitionByRange(*cluster_by))
    return ranged.sortWithinPartitions(*cluster_by)


def write_parquet(df: DataFrame, path: str, cluster_by: list[str] | None = None,
                  partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = clustered(df, cluster_by).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


#: Table property: the folder of the version before.
PREVIOUS = "tillroll.previous"


def _detail(spark: SparkSession, table: str) -> dict[str, str]:
    """The catalog's entries for a table (``Location``, ``Provider``, ...)."""
    return {r.col_name: r.data_type
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _switch(spark: SparkSession, table: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def _remove(spark: SparkSession, location: str) -> None:
    fs, path = file_system(spark, location)
    fs.delete(path, True)


#: Months are the folders of a stored cube; inside, rows lie by product and region.
CUBE_FOLDERS = ["sale_year", "num_month"]


def write_cube(cube: DataFrame, path: str) -> None:
    """The cube as a store for queries by month: a folder a month, which a filter on year and month
    number picks without opening the others. A large month is several files."""
    write_parquet(cube, path, [*CUBE_FOLDERS, "product_id", "region"], CUBE_FOLDERS)


def read_cube(spark: SparkSession, path: str) -> DataFrame:
    types = cube_types("warehouse")
    schema = ddl({c: types[c] for c in CUBE_COLUMNS})
    return spark.read.schema(schema).parquet(path).select(*CUBE_COLUMNS)


def refresh_table(spark: SparkSession, df: DataFrame, table: str, types: dict[str, str],
                  cluster_by: list[str] | None = None, fmt: str = "parquet",
                  check: Callable[[DataFrame], None] | None = None) -> None:
    """Full refresh of an unpartitioned catalog table with a fixed type contract.

    Creates the table if absent, adds contract columns it lacks (additive
    evolution: nothing is dropped or retyped) and casts the rows to the contract.

    Each version is written to a folder of its own beside the table's first
    one, through a table of the same column types, so that the catalog's own checks hold
    (a text longer than its ``varchar`` is refused). When it is complete, ``check`` gets the
    written rows and may raise; then one catalog change (``SET LOCATION``) switches the table
    to it. The version before stays for readers that began on it, until the next refresh.
    A run that stops at any step leaves the table with all old or all new rows, and at most a
    folder and the entry of the table (``<table>__v...``) that wrote it. ``df`` may read the table it replaces. Statistics are
    computed after the switch.
    """
    create_table_if_absent(spark, table, types, fmt)
    add_missing_columns(spark, table, types)
    known = {c.lower(): c for c in types}
    schema = spark.read.table(table).schema
    columns, kinds = [], {}
    for field in schema.fields:
        name = known.get(field.name.lower())
        # A column the table has but the contract no longer lists stays, empty.
        columns.append(F.col(name).cast(value_type(types[name])).alias(field.name) if name
                       else F.lit(None).cast(field.dataType).alias(field.name))
        kinds[field.name] = types[name] if name else field.dataType.simpleString()
    detail = _detail(spark, table)
    old, provider = detail["Location"].rstrip("/"), detail["Provider"]
    version = uuid.uuid4().hex
    new, staging = f"{re.sub('__v[0-9a-f]{32}$', '', old)}__v{version}", f"{table}__v{version}"
    try:
        spark.sql(f"CREATE TABLE {staging} ({ddl(kinds)}) USING {provider} LOCATION '{new}'")
        try:
            clustered(df.select(*columns), cluster_by).write.insertInto(staging)
        finally:
            spark.sql(f"DROP TABLE {staging}")  # its files stay: the location was given
        if check:
            check(spark.read.format(provider).schema(schema).load(new))
    except Exception:
        _remove(spark, new)
        raise
    _switch(spark, table, new)
    before = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(PREVIOUS)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{old}')")
    if before:
        _remove(spark, before)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batch_size: int = 50_000, column_types: dict[str, str] | None = None,
               max_connections: int | None = None) -> None:
    """Full refresh of a database table over JDBC.

    ``truncate`` keeps the table and its DDL (keys, types) and empties it
    before the insert; rows go in batches of ``batch_size`` from every
    partition in parallel, at most ``max_connections`` at a time. Like any
    JDBC load this is not atomic: a failed run leaves a partial table.
    """
    writer = (df.write.mode("overwrite").option("truncate", "true")
              .option("batchsize", str(batch_size)))
    if column_types:
        writer = writer.option("createTableColumnTypes",
                               ", ".join(f"{c} {t}" for c, t in column_types.items()))
    if max_connections:
        writer = writer.option("numPartitions", str(max_connections))
    writer.jdbc(url, table, properties=dict(properties or {}))
