"""Scalar helpers against Python's own arithmetic and formatting, on a few
thousand random values in one Spark job each."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tillroll.functions.rounding import half_up, mean_tenths, tenths, toward_zero
from tillroll.functions.text import bar_label, fixed1, thousands, tick_label


def _half_up(num, den):
    return int((Decimal(num) / Decimal(den)).quantize(Decimal(1), rounding=ROUND_HALF_UP))


def test_integer_rounding(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(-10**12, 10**12), rng.randint(1, 10**6)) for _ in range(3000)]
    pairs += [(k * 5, 10) for k in range(-50, 50)]           # exact ties
    df = spark.createDataFrame(pairs, "num bigint, den bigint")
    got = df.selectExpr("num", "den", f"{half_up('num', 'den')} AS r",
                        f"{toward_zero('num', 'den')} AS t").collect()
    for row in got:
        assert row.r == _half_up(row.num, row.den), row
        assert row.t == int(Decimal(row.num) / Decimal(row.den)), row


def test_mean_of_tenths(spark):
    df = spark.createDataFrame([(None, 0), (25, 2), (-25, 2), (7, 3)], "total bigint, n bigint")
    got = [r[0] for r in df.selectExpr(f"{tenths(mean_tenths('total', 'n'))}").collect()]
    assert got == [None, 1.3, -1.3, 0.2]


def test_formats_match_python(spark):
    rng = random.Random(11)
    values = [rng.randint(0, 10**8) / 10 for _ in range(2000)]
    values += [k + 0.5 for k in range(0, 40)] + [999999.95, 1000000.0, 1234567.5, 2500000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", thousands(F.col("v").cast("bigint")).alias("t"), fixed1(F.col("v")).alias("f"),
                     bar_label(F.col("v")).alias("b"), tick_label(F.col("v")).alias("k")).collect()
    for r in rows:
        v = r.v
        assert r.t == f"{int(v):,}"
        assert r.f == f"{v:,.1f}", v
        assert r.b == (f"{v / 1e6:.2f}M" if v >= 1e6 else f"{v:,.1f}"), v
        assert r.k == (f"{v / 1e6:.1f}M" if v >= 1e6 else f"{v:,.0f}"), v
