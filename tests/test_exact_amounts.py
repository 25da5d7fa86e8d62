"""Cell means and sums of amounts with any decimals, against Python's exact fractions."""

import random
from decimal import Decimal
from fractions import Fraction

import pytest

from tillroll.operators.cells import cell_aggregate

COLUMNS = ("sale_id long, customer_id int, product_id int, quantity int, sale_date date, "
           "price_product double, sale_amount {}, region string")


def tenths_half_away(x: Fraction) -> int:
    n = (abs(x) * 20 + 1) // 2  # floor of tenths plus one half
    return int(n) if x >= 0 else -int(n)


def expected(amounts):
    total = sum(map(Fraction, amounts), Fraction(0))
    mean = tenths_half_away(total / len(amounts)) / 10
    whole = abs(tenths_half_away(total)) // 10
    return mean, whole if total >= 0 else -whole


def cells(spark, groups, kind, parts=1):
    rows = [(i, 1, p, 1, None, 1.0, a, "N") for p, amounts in enumerate(groups) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, COLUMNS.format(kind)).repartition(parts)
    return {r.product_id: (r.avg_receipt, r.sum_amount) for r in cell_aggregate(df).collect()}


def groups_of(rnd):
    groups = [[rnd.choice([-1, 1]) * round(rnd.uniform(0, 10 ** rnd.randint(0, 9)), rnd.randint(0, 12))
               for _ in range(rnd.randint(1, 40))] for _ in range(150)]
    ties = [[0.05], [-0.05], [0.25, 0.25], [0.1, 0.2], [0.1] * 10, [1e-12] * 5, [0.049999999999], [9e9, 0.05],
            [1.05e10, -1e10, 0.05], [123456789.123456, 0.000001], [0.004] * 1000, [1e15, 0.35, -1e15]]
    return groups + ties


def test_doubles_of_any_decimals(spark):
    groups = groups_of(random.Random(3))
    # the shortest decimal that prints the double, to twelve decimals
    shortest = [[round(Decimal(repr(a)), 12) for a in g] for g in groups]
    want = {i: expected(g) for i, g in enumerate(shortest)}
    for parts in (1, 7):  # any order of summation, one result
        got = cells(spark, groups, "double", parts)
        assert {i: (groups[i], got[i], w) for i, w in want.items() if got[i] != w} == {}


@pytest.mark.parametrize("kind,scale", [("decimal(12,2)", 2), ("decimal(18,6)", 6), ("decimal(24,9)", 9)])
def test_decimals(spark, kind, scale):
    rnd = random.Random(5)
    groups = [[Decimal(rnd.randint(-10 ** 9, 10 ** 9)).scaleb(-scale) for _ in range(rnd.randint(1, 30))]
              for _ in range(60)]
    want = {i: expected(g) for i, g in enumerate(groups)}
    assert cells(spark, groups, kind, 3) == want


def test_nulls_and_large_sums(spark):
    got = cells(spark, [[None, None], [None, 0.25], [8e9] * 2000], "double")
    assert got[0] == (None, None) and got[1] == (0.3, 0)
    assert got[2] == (8e9, 16_000_000_000_000)
