"""The seeded generator: quotas, ranges, determinism across partitionings."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.sources.generator import REGIONS, generate_sales, price_list, quotas

AS_OF = dt.date(2026, 12, 3)


def test_quotas_ranges_and_types(spark):
    n = 20_000
    g = generate_sales(spark, n, AS_OF, num_partitions=4)
    prof = {r.region: r for r in g.groupBy("region").agg(
        F.count("*").alias("n"), F.min("product_id").alias("pmin"), F.max("product_id").alias("pmax"),
        F.min("quantity").alias("qmin"), F.max("quantity").alias("qmax"),
        F.min("sale_date").alias("dmin"), F.max("sale_date").alias("dmax"),
        F.min("customer_id").alias("cmin"), F.max("customer_id").alias("cmax")).collect()}
    for (name, _, (plo, phi), (qlo, qhi)), size in zip(REGIONS, quotas(n)):
        r = prof[name]
        assert r.n == size
        assert (r.pmin, r.pmax) == (plo, phi)
        assert (r.qmin, r.qmax) == (qlo, qhi)
        assert r.dmin == AS_OF - dt.timedelta(days=365)
        assert r.dmax == AS_OF - dt.timedelta(days=2)
        assert 1 <= r.cmin and r.cmax <= 5000
    assert g.select("sale_id").distinct().count() == sum(quotas(n))
    types = dict(g.dtypes)
    assert types["sale_amount"] == "decimal(12,2)" and types["sale_date"] == "date"
    bad = g.where(F.col("sale_amount") != F.col("quantity") * F.col("price_product")).count()
    assert bad == 0


def test_independent_of_partitioning(spark):
    a = generate_sales(spark, 5000, AS_OF, num_partitions=1)
    b = generate_sales(spark, 5000, AS_OF, num_partitions=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_price_tiers(spark):
    prices = {r.product_id: r.price_cents for r in price_list(spark).collect()}
    assert sorted(prices) == list(range(1, 71))
    assert all(100 <= prices[p] < 3000 for p in range(1, 21))
    assert all(10000 <= prices[p] < 50000 for p in range(21, 51))
    assert all(100000 <= prices[p] < 500000 for p in range(51, 71))


def test_multiplier_is_coprime_for_any_total():
    import math

    from tillroll.sources.generator import PERMUTE_A, multiplier
    assert multiplier(1_000_000) == PERMUTE_A
    for total in (PERMUTE_A, PERMUTE_A * 2, PERMUTE_A * 3 * (PERMUTE_A + 2)):
        a = multiplier(total)
        assert math.gcd(a, total) == 1 and a != PERMUTE_A


def test_small_n_covers_every_id_once(spark):
    # a changed multiplier needs a total of at least 7,368,787 rows; the
    # bijection itself only needs gcd(A, total) = 1, checked above
    from tillroll.sources.generator import quotas
    g = generate_sales(spark, 20, AS_OF, num_partitions=3)
    assert sorted(r.sale_id for r in g.collect()) == list(range(1, sum(quotas(20)) + 1))
