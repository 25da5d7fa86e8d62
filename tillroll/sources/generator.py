"""Seeded synthetic sales rows, generated on the executors.

The contract is the distribution, not a particular random stream:

* ``sale_id`` 1..N, where N is the sum of the regional quotas;
* exact regional quotas (45 / 25 / 20 / 10 % of n, rounded down);
* per region a product range and a quantity range;
* customer 1..5000, day uniform over the 364 days from ``as_of - 365``;
* one price per product, by tier, in cents.

Every value is a function of (seed, row id) only: one md5 per row gives four
independent 32-bit streams. Regions are assigned through the bijection
``k = (id * A + B) mod N``, so the quotas are exact without a shuffle and rows
of one region are spread over all partitions. No value depends on how the
id range is split into partitions.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the workload: regions with their weight in percent, product
# range and quantity range (both inclusive), and the price tiers by product.
REGIONS = [
    # name,  weight %, products, quantity
    ("North", 45, (1, 30), (1, 2)),
    ("South", 25, (21, 50), (1, 9)),
    ("East", 20, (30, 65), (1, 9)),
    ("West", 10, (51, 70), (5, 19)),
]
QUANTITY_CLIP = {"North": (1, 10), "South": (1, 30), "East": (1, 30), "West": (1, 50)}
PRICE_TIERS_CENTS = [
    # first product, last product, lowest price, highest price (exclusive), in cents
    (1, 20, 100, 3000),
    (21, 50, 10000, 50000),
    (51, 70, 100000, 500000),
]
ROWS_PER_PARTITION = 5_000_000
N_PRODUCTS = 70
N_CUSTOMERS = 5000
DAYS_BACK = 365
N_DAYS = 364

# Multiplier and offset of the region permutation; A is prime.
PERMUTE_A = 7368787
PERMUTE_B = 12345


def multiplier(total: int) -> int:
    """PERMUTE_A, or the next odd number coprime with ``total`` when ``total``
    shares a factor with it: ``id -> (id * A + B) mod total`` must be a
    bijection."""
    a = PERMUTE_A
    while math.gcd(a, total) != 1:
        a += 2
    return a


def quotas(n: int) -> list[int]:
    return [n * weight // 100 for _, weight, _, _ in REGIONS]


def _stream(h: Column, i: int) -> Column:
    """The i-th 32-bit unsigned integer of a hex md5 digest."""
    return F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint")


def _cents_to_decimal(cents: Column, dtype: str) -> Column:
    """Exact: integer cents / 100 in decimal arithmetic."""
    return (cents.cast("decimal(20,0)") / F.lit(100)).cast(dtype)


def price_list(spark: SparkSession, seed: int = 42) -> DataFrame:
    """(product_id, price_cents) for the 70 products."""
    pid = F.col("id").cast("int")
    u = _stream(F.md5(F.concat(F.lit(f"{seed}p:"), pid.cast("string"))), 0)
    cents = None
    for first, last, lo, hi in PRICE_TIERS_CENTS:
        branch = F.lit(lo) + u % (hi - lo)
        cond = pid.between(first, last)
        cents = F.when(cond, branch) if cents is None else cents.when(cond, branch)
    return spark.range(1, N_PRODUCTS + 1, numPartitions=1).select(
        pid.alias("product_id"), cents.cast("bigint").alias("price_cents"))


def generate_sales(spark: SparkSession, n: int, as_of: _dt.date | str, seed: int = 42,
                   num_partitions: int | None = None) -> DataFrame:
    """Raw sales rows in the 8-column layout; amounts as decimal(12,2).
    ``as_of`` (a date or 'YYYY-MM-DD') is the run day: sales fall on the 364
    days from ``as_of - 365``."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    sizes = quotas(n)
    total = sum(sizes)
    if total == 0:
        raise ValueError("n too small for the regional quotas")
    a = multiplier(total)

    # Bounded tasks: a lost task regenerates at most ROWS_PER_PARTITION rows.
    if num_partitions is None:
        num_partitions = max(spark.sparkContext.defaultParallelism,
                             -(-total // ROWS_PER_PARTITION))
    ids = spark.range(0, total, numPartitions=num_partitions)
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    # id * A + B must stay exact: bigint while it fits, decimal beyond.
    ident = F.col("id") if total * a + PERMUTE_B < 2 ** 63 \
        else F.col("id").cast("decimal(38,0)")
    k = ((ident * a + PERMUTE_B) % total).cast("bigint")

    region = product = quantity = None
    bound = 0
    u_product, u_quantity = _stream(h, 1), _stream(h, 2)
    for (name, _, (plo, phi), (qlo, qhi)), size in zip(REGIONS, sizes):
        bound += size
        cond = k < bound
        clip_lo, clip_hi = QUANTITY_CLIP[name]
        p = F.lit(plo) + u_product % (phi - plo + 1)
        q = F.least(F.greatest(F.lit(qlo) + u_quantity % (qhi - qlo + 1), F.lit(clip_lo)),
                    F.lit(clip_hi))
        if region is None:
            region, product, quantity = (F.when(cond, F.lit(name)), F.when(cond, p),
                                         F.when(cond, q))
        else:
            region, product, quantity = (region.when(cond, F.lit(name)), product.when(cond, p),
                                         quantity.when(cond, q))

    first_day = as_of - _dt.timedelta(days=DAYS_BACK)
    rows = ids.select(
        (F.col("id") + 1).alias("sale_id"),
        (F.lit(1) + _stream(h, 0) % N_CUSTOMERS).cast("int").alias("customer_id"),
        product.cast("int").alias("product_id"),
        quantity.cast("int").alias("quantity"),
        F.date_add(F.lit(first_day), (_stream(h, 3) % N_DAYS).cast("int")).alias("sale_date"),
        region.alias("region"),
    )
    # The price list has exactly N_PRODUCTS rows: broadcasting it is bounded.
    prices = F.broadcast(price_list(spark, seed))
    return rows.join(prices, "product_id", "left").select(
        "sale_id", "customer_id", "product_id", "quantity", "sale_date",
        _cents_to_decimal(F.col("price_cents"), "decimal(10,2)").alias("price_product"),
        _cents_to_decimal(F.col("quantity") * F.col("price_cents"), "decimal(12,2)")
        .alias("sale_amount"),
        "region",
    )
