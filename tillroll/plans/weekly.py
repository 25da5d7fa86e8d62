"""The weekly refresh as one Spark application.

    raw sales -> written once, checked (primary key, region length) -> table ``sales``
              -> cube -> table ``sales_aggregated`` (row-store types)
                      -> table ``sales_aggregated_wh`` (+ import_date,
                         clustered by year, month, product, region; may live in
                         its own warehouse database)
              -> row counts and report, one row per store

Each step reads the table the previous step wrote, so lineage is cut at
every table and a lost executor costs at most one step's work. The tables
live in a catalog database whose location is the shared warehouse folder.
Scheduling, retries and notification delivery are left to the scheduler
that runs this job.

Command line::

    python -m tillroll.plans.weekly --generate 1000000 --database sales_db \
        --warehouse-database sales_wh
    python -m tillroll.plans.weekly --csv /shared/raw/sales --database sales_db
"""

from __future__ import annotations

import argparse
import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import contracts, monitoring
from tillroll.plans.cube import sales_cube
from tillroll.schemas import REGION_MAX_LENGTH, ROWSTORE_SALES_TYPES, cube_types
from tillroll.session import remove_stored, shared_folder
from tillroll.sources.sinks import refresh_table

SALES_TABLE = "sales"
CUBE_TABLE = "sales_aggregated"
WAREHOUSE_TABLE = "sales_aggregated_wh"


class ContractError(ValueError):
    """Raw rows that the sales table's contract would refuse."""


def check_raw(raw: DataFrame) -> None:
    """Refuse the batch if a key repeats or is null, or a region is too long (the table's own
    type refuses it as well). ``raw`` reads written files: where these hold narrow key ranges, the
    key check shuffles bitmaps instead of keys."""
    if contracts.pk_violations_by_range(raw).limit(1).count():
        raise ContractError("sale_id is not a primary key of the batch")
    if raw.where(F.length("region") > REGION_MAX_LENGTH).limit(1).count():
        raise ContractError(f"region longer than {REGION_MAX_LENGTH} characters")


def run_weekly(spark: SparkSession, raw: DataFrame, database: str = "default",
               import_date: _dt.date | None = None,
               warehouse_database: str | None = None) -> DataFrame:
    """Load ``raw`` and rebuild the cube tables. The raw and row-store cube
    tables go to ``database``, the warehouse cube to ``warehouse_database``
    (default: the same). Returns the row-count report, one row per store
    ('rowstore', 'warehouse'; one 'warehouse' row when they share a
    database), with the warehouse cube's latest import day."""
    wh_database = warehouse_database or database
    for db in {database, wh_database}:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    name = f"{database}.{{}}".format
    wh_name = f"{wh_database}.{{}}".format
    # The raw source is read once: the checks run on the written rows, before the switch.
    refresh_table(spark, contracts.whole_cents(raw), name(SALES_TABLE), ROWSTORE_SALES_TYPES,
                  check=check_raw)

    # The key was checked: no two rows are equal, so the full-row
    # de-duplication (a shuffle of every column) is skipped; the key check
    # shuffled one column.
    folder = f"{shared_folder(spark)}/weekly-{uuid.uuid4().hex}"
    try:
        cube = sales_cube(spark.read.table(name(SALES_TABLE)), dedup=False, folder=folder)
        refresh_table(spark, cube, name(CUBE_TABLE), cube_types("rowstore"))
    finally:
        remove_stored(spark, folder)

    stored = spark.read.table(name(CUBE_TABLE))
    warehouse = contracts.warehouse_cube(stored, import_date)
    refresh_table(spark, warehouse, wh_name(WAREHOUSE_TABLE), cube_types("warehouse"),
                  cluster_by=["sale_year", "num_month", "product_id", "region"])

    if wh_database == database:
        stores = {"warehouse": database}
    else:
        stores = {"rowstore": database, "warehouse": wh_database}
    counts = reduce(DataFrame.unionByName,
                    [monitoring.catalog_row_counts(spark, src, db) for src, db in stores.items()])
    latest = monitoring.latest_import(spark.read.table(wh_name(WAREHOUSE_TABLE))).scalar()
    return monitoring.row_count_report(counts, list(stores)).withColumn("latest_import", latest)


def main(argv: list[str] | None = None) -> None:
    from tillroll.session import configure
    from tillroll.sources.files import read_sales_csv
    from tillroll.sources.generator import generate_sales

    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    group = parser.add_mutually_exclusive_group(required=True)
    group.add_argument("--csv", help="folder of raw sales CSV files with a header")
    group.add_argument("--generate", type=int, help="generate this many raw sales rows")
    parser.add_argument("--database", default="default")
    parser.add_argument("--warehouse-database", default=None)
    parser.add_argument("--as-of", type=_dt.date.fromisoformat, default=_dt.date.today())
    parser.add_argument("--seed", type=int, default=42)
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName("tillroll-weekly").getOrCreate())
    raw = (read_sales_csv(spark, args.csv) if args.csv
           else generate_sales(spark, args.generate, args.as_of, args.seed))
    report = run_weekly(spark, raw, args.database, args.as_of, args.warehouse_database)
    for row in report.collect():  # one row per source: a few lines of text
        print(f"import date: {row['latest_import']}")
        print(f"{row['source']} (total rows: {row['total_rows']:,}):\n{row['report']}")


if __name__ == "__main__":
    main()
