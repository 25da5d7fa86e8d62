"""The sales fact on the driver's TPC-H-style tables.

Mapping (one sale per line item):

    sale_id       l_orderkey * 10 + l_linenumber   (not unique: only for pk checks)
    customer_id   o_custkey
    product_id    brand number of the part          ('Brand#13' -> 13)
    quantity      l_quantity as int
    sale_date     l_shipdate as date
    price_product p_retailprice
    sale_amount   l_extendedprice                   (at most two decimals)
    region        region name of the customer's nation
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


#: The schemas of the star tables. Given to the reader they save a footer job a table.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def order_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_custkey, region) of every order.

    Orders meet customers first, while the customer side is a plain scan: the
    planner then sees its real size and broadcasts it only below the
    broadcast threshold (a sort-merge join above it). Nation and region have
    a fixed number of rows and follow as broadcast joins.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").selectExpr("r_regionkey", "r_name AS region")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        .join(customer, F.expr("o_custkey = c_custkey"))
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .select("o_orderkey", "o_custkey", "region")
    )


def products(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    """(p_partkey, product_id, price_product); product_id is the brand number,
    or the part key itself at ``grain='part'`` (about one row per cube cell)."""
    pid = ("CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT)" if grain == "brand"
           else "p_partkey")
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey", f"{pid} AS product_id", "p_retailprice AS price_product")


#: ``sale_amount`` after discount and tax: up to six decimals.
FINE_AMOUNT = ("CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) "
               "* (1 + CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE)")


def sales_fact(spark: SparkSession, sf_dir: str, grain: str = "brand",
               amount: str = "l_extendedprice") -> DataFrame:
    """The 8-column sales fact: line items joined to their orders (with the
    customer's region) and to their parts.

    Line items and orders both grow with the data, so they meet in a shuffle
    (sort-merge) join at any size: a broadcast of orders would be built on
    the driver and shipped to every task. Parts are left to the planner,
    which broadcasts them only below its size threshold.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_shipdate")
    return (
        lines.join(order_regions(spark, sf_dir).hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .join(products(spark, sf_dir, grain), F.expr("l_partkey = p_partkey"))
        .selectExpr(
            "l_orderkey * 10 + l_linenumber AS sale_id",
            "o_custkey AS customer_id",
            "product_id",
            "CAST(l_quantity AS INT) AS quantity",
            "CAST(l_shipdate AS DATE) AS sale_date",
            "price_product",
            f"{amount} AS sale_amount",
            "region",
        )
    )
