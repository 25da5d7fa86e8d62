"""Named queries over the test tables: ``QUERIES[name](spark, sf_dir)``.

Each query reads the whole tables it needs and returns a lazy DataFrame.
The DuckDB statements that must give the same rows are in
``tillroll.plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import epoch_seconds, epoch_to_date, ts_text, date_parts
from tillroll.operators import contracts, monitoring, presentation
from tillroll.operators.cells import cell_aggregate, cells_with_tenths
from tillroll.operators.dedup import dedup_by_digest, dedup_full_row
from tillroll.operators.lookup import lookup
from tillroll.operators.rollups import TOTAL, grouped_rollups
from tillroll.operators.topk import top_products_from_cells, top_products_sql
from tillroll.plans.cube import sales_cube
from tillroll.plans.stored import stored_cube
from tillroll.schemas import DIMENSIONS, SALES_COLUMNS
from tillroll.session import shared_folder, stored
from tillroll.sources.files import read_sales_csv_rejects
from tillroll.sources.sinks import write_sales_csv
from tillroll.sources.testdata import FINE_AMOUNT, TABLES, sales_fact, table

# Parameters of the registered queries. Both October and September 2001
# have sales in the test tables.
AS_OF = _dt.date(2001, 10, 15)
TOP_K = 10
SOURCE = "parquet"

Query = Callable[[SparkSession, str], DataFrame]


def _cells(spark, sf_dir, grain="brand"):
    return cells_with_tenths(dedup_full_row(sales_fact(spark, sf_dir, grain)))


def _cube(spark, sf_dir, dims=None, grain="brand"):
    return sales_cube(sales_fact(spark, sf_dir, grain), dims)


def _top(metric: str, months: int) -> Query:
    """Top-k over the cube built from the raw tables; the one-pass form gives
    the same rows as ``top_products`` over a stored cube."""
    def run(spark, sf_dir):
        return top_products_from_cells(_cells(spark, sf_dir), metric, AS_OF, months, TOP_K)
    return run


def _top_stored(metric: str, months: int) -> Query:
    """Top-k as users ask it: SQL over the stored cube."""
    def run(spark, sf_dir):
        view = f"stored_cube_{uuid.uuid4().hex}"
        stored_cube(spark, sf_dir).createOrReplaceTempView(view)
        return top_products_sql(spark, view, metric, AS_OF, months, TOP_K)
    return run


def _undated(spark, sf_dir):
    """The fact with no date in every seventh sale."""
    return sales_fact(spark, sf_dir).withColumn("sale_date", F.expr(
        "CASE WHEN sale_id % 7 <> 0 THEN sale_date END"))


def _copies(spark, sf_dir):
    """The stored fact and a fiftieth of it again."""
    fact = stored(sales_fact(spark, sf_dir), "fact")
    return stored(fact.unionAll(fact.where("sale_id % 50 = 0")), "fact-with-copies")


#: Cells of the fact made unreadable by a rule: column -> (condition, text).
BROKEN = {
    "quantity": ("sale_id % 31 = 0", "concat('x', quantity)"),
    "sale_date": ("sale_id % 37 = 0", "date_format(sale_date, 'dd.MM.yyyy')"),
    "price_product": ("sale_id % 41 = 0", "'n/a'"),
    "customer_id": ("sale_id % 43 = 0", "concat('9', customer_id, '0000000000')"),
}


def _csv_rejects(spark, sf_dir):
    """The fact as CSV with broken cells, read back: rows and sales amount by broken column ('-': good)."""
    fact = sales_fact(spark, sf_dir)
    cells = [F.expr(f"CASE WHEN {BROKEN[c][0]} THEN {BROKEN[c][1]} ELSE CAST({c} AS STRING) END").alias(c)
             if c in BROKEN else F.col(c) for c in SALES_COLUMNS]
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    write_sales_csv(fact.select(*cells), path)
    good, rejects = read_sales_csv_rejects(spark, path)
    n = F.count("*").alias("n_rows")
    return good.select(F.lit("-").alias("column_name")).groupBy("column_name").agg(n).union(
        rejects.select(F.explode("reasons").alias("r")).select(
            F.substring_index("r", ":", 1).alias("column_name")).groupBy("column_name").agg(n))


#: Stores of the message: title -> its tables.
STORES = {"star": ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"],
          "corpus": ["events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]}


def _row_counts_message(spark, sf_dir):
    parts = [monitoring.parquet_row_counts(spark, {t: f"{sf_dir}/{t}.parquet" for t in tables}, s)
             for s, tables in STORES.items()]
    latest = table(spark, sf_dir, "events").select(F.max(ts_text("ts")))
    return monitoring.row_count_message(
        parts[0].unionByName(parts[1]), {s: s.title() for s in STORES}, "Rows", latest.scalar())


def _chart(metric: str, value: str) -> Query:
    def run(spark, sf_dir):
        return presentation.chart_labels(_top(metric, 0)(spark, sf_dir), value)
    return run


def _row_counts(spark, sf_dir):
    return monitoring.parquet_row_counts(
        spark, {name: f"{sf_dir}/{name}.parquet" for name in TABLES}, SOURCE)


def _warehouse(spark, sf_dir):
    cube = _cube(spark, sf_dir)
    day = F.when(F.col("sale_year") == AS_OF.year, F.lit(AS_OF)) \
        .otherwise(F.date_sub(F.lit(AS_OF), 7))
    return contracts.warehouse_cube(cube, day)


def _lineitem_parts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return lookup(lines, parts, F.col("l_partkey") == F.col("p_partkey"), "left")


def _sale_amount_derived(spark, sf_dir):
    joined = _lineitem_parts(spark, sf_dir)
    amount = F.round(F.col("l_quantity").cast("int")
                     * F.col("p_retailprice").cast("decimal(10,2)"), 2)
    return joined.select("l_orderkey", "l_linenumber",
                         amount.cast("decimal(12,2)").alias("sale_amount"))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


QUERIES: dict[str, Query] = {
    # 1. the weekly job's result (flagship)
    "sales_cube": lambda s, d: _cube(s, d),
    # 2. its parts
    "sales_fact": lambda s, d: sales_fact(s, d),
    # distinct days first, then the parts of each day (not of each sale)
    "date_parts": lambda s, d: sales_fact(s, d).select("sale_date").distinct().select(
        "sale_date", *[e.alias(n) for n, e in date_parts("sale_date").items()]),
    "dedup_full_row": lambda s, d: dedup_full_row(
        sales_fact(s, d).unionAll(sales_fact(s, d))),
    "cell_aggregate": lambda s, d: cell_aggregate(dedup_full_row(sales_fact(s, d))),
    "rollup_region": lambda s, d: _cube(s, d, dims=["region"]),
    "rollup_month_year": lambda s, d: _cube(s, d, dims=["month_year"]),
    "rollup_product": lambda s, d: _cube(s, d, dims=["product_id"]),
    "sales_cube_part_grain": lambda s, d: _cube(s, d, grain="part"),
    # the cube of amounts with up to six decimals, of a fact that stands twice, and with undated sales
    "sales_cube_fine": lambda s, d: sales_cube(sales_fact(s, d, amount=FINE_AMOUNT)),
    "sales_cube_twice": lambda s, d: sales_cube(sales_fact(s, d).unionAll(sales_fact(s, d))),
    "sales_cube_undated": lambda s, d: sales_cube(_undated(s, d)),
    "dedup_by_digest": lambda s, d: dedup_by_digest(_copies(s, d)),
    # 3. top-k
    "top10_receipt_cur": _top("receipt", 0),
    "top10_amount_cur": _top("amount", 0),
    "top10_amount_prev": _top("amount", 1),
    "top10_receipt_prev": _top("receipt", 1),
    "top10_stored_receipt_cur": _top_stored("receipt", 0),
    "top10_stored_amount_cur": _top_stored("amount", 0),
    "top10_stored_amount_prev": _top_stored("amount", 1),
    "top10_stored_receipt_prev": _top_stored("receipt", 1),
    # distinct (product, metric) of the cube = the product roll-up itself
    "distinct_product_metric": lambda s, d: presentation.dashboard_product(_cells(s, d)).select(
        "product_id", F.col("avg_receipt_product_id").alias("avg_receipt")),
    # 4. monitoring
    "row_counts": _row_counts,
    "row_counts_total": lambda s, d: monitoring.row_count_totals(_row_counts(s, d)),
    "row_counts_report": lambda s, d: monitoring.row_count_report(_row_counts(s, d)),
    "row_counts_message": _row_counts_message,
    "latest_import": lambda s, d: monitoring.latest_import(_warehouse(s, d)),
    "not_in_filter": lambda s, d: _events(s, d)
        .where(~F.col("event_type").isin("error", "signup"))
        .groupBy("event_type").agg(F.count(F.lit(1)).alias("n")),
    # 5. contracts
    "load_contract_sales": lambda s, d: contracts.sales_contract(sales_fact(s, d)),
    "load_contract_rowstore": lambda s, d: contracts.rowstore_cube(_cube(s, d)),
    "load_contract_warehouse": lambda s, d: contracts.warehouse_cube(_cube(s, d), AS_OF),
    "pk_violations": lambda s, d: contracts.pk_violations(
        table(s, d, "lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"))),
    "pk_violations_by_range": lambda s, d: contracts.pk_violations_by_range(
        table(s, d, "lineitem"), "l_orderkey * 10 + l_linenumber").withColumnRenamed("key", "sale_id"),
    "csv_rejects": _csv_rejects,
    "schema_evolution": lambda s, d: contracts.union_evolved(
        cell_aggregate(dedup_full_row(sales_fact(s, d))), _cube(s, d)),
    # 6. lookups
    # a left join that misses: a third of the customers have no orders
    "orders_lookup": lambda s, d: lookup(
        table(s, d, "customer").select("c_custkey"),
        table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.count(F.lit(1)).alias("n_orders")), "c_custkey"),
    "price_lookup": lambda s, d: _lineitem_parts(s, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_retailprice"),
    "sale_amount_derived": _sale_amount_derived,
    "clip_quantity": lambda s, d: table(s, d, "lineitem").groupBy("l_returnflag").agg(
        F.sum(F.least(F.greatest(F.col("l_quantity").cast("int"), F.lit(5)), F.lit(30)))
        .alias("clipped_quantity")),
    "epoch_to_date": lambda s, d: _events(s, d).select(
        "event_id", epoch_seconds("ts").alias("epoch_s"),
        epoch_to_date(epoch_seconds("ts")).alias("event_date")),
    # 7. presentation
    "chart_labels_receipt": _chart("receipt", "avg_receipt"),
    "chart_labels_amount": _chart("amount", "amount"),
    "dashboard_region": lambda s, d: presentation.dashboard_region(_cells(s, d)),
    "dashboard_product": lambda s, d: presentation.dashboard_product(_cells(s, d)),
    "dashboard_period": lambda s, d: presentation.dashboard_period(_cells(s, d)),
    # the three views and the grand total from one pass
    "dashboard_all": lambda s, d: grouped_rollups(_cells(s, d), [*DIMENSIONS, TOTAL]),
    "ts_text": lambda s, d: _events(s, d).select("event_id", ts_text("ts").alias("ts_text")),
}
