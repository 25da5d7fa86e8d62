"""The sales cube: golden fixture, window-form brute force, invariants."""

import os
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import RAW_CSV, expected_rows, raw_rows
from tillroll.operators.cells import cell_aggregate
from tillroll.operators.dedup import dedup_full_row
from tillroll.plans.cube import sales_cube
from tillroll.schemas import CELL_MEASURES, CUBE_COLUMNS, DIMENSIONS, SALES_SCHEMA
from tillroll.sources.files import read_sales_csv
from tillroll.sources.testdata import sales_fact


def _csv(spark):
    d = tempfile.mkdtemp(prefix="golden-")
    path = os.path.join(d, "sales.csv")
    with open(path, "w") as f:
        f.write(RAW_CSV)
    return read_sales_csv(spark, path)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda r: tuple("" if v is None else str(v) for v in r))


def test_golden_cube(spark):
    cube = sales_cube(_csv(spark))
    assert cube.columns == CUBE_COLUMNS
    assert _rows(cube) == sorted(expected_rows(),
                                 key=lambda r: tuple("" if v is None else str(v) for v in r))


def test_golden_cube_with_inferred_schema(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(RAW_CSV)
    from tillroll.sources.files import read_sales_csv as read
    inferred = read(spark, str(path), infer_schema=True)
    assert dict(inferred.dtypes)["sale_date"] == "date"
    assert _rows(sales_cube(inferred)) == _rows(sales_cube(_csv(spark)))


def test_golden_from_python_rows(spark):
    df = spark.createDataFrame(raw_rows(), SALES_SCHEMA)
    assert _rows(sales_cube(df)) == _rows(sales_cube(_csv(spark)))


def _window_form(cells):
    """The roll-ups as whole-partition window aggregates (the reference's
    formulation), in the same integer arithmetic."""
    out = cells.withColumns({
        "_r10": F.round(F.col("avg_receipt") * 10).cast("bigint"),
        "_q10": F.round(F.col("avg_receipt_quantity") * 10).cast("bigint"),
    })
    for dim, keys in DIMENSIONS.items():
        w = Window.partitionBy(*keys)

        def mean(col):
            s, n = F.sum(col).over(w), F.count(col).over(w)
            sign = F.when(s < 0, -1).otherwise(1)
            return sign * F.call_function("div", F.abs(s) * 2 + n, n * 2) / 10.0

        out = out.withColumns({
            f"avg_receipt_{dim}": mean("_r10"),
            f"sum_amount_{dim}": F.sum("sum_amount").over(w),
            f"count_sales_{dim}": F.sum("count_sales").over(w),
            f"sum_quantity_{dim}": F.sum("sum_quantity").over(w),
            f"avg_receipt_quantity_{dim}": mean("_q10"),
        })
    return out.select(*CUBE_COLUMNS)


def test_rollups_equal_window_form(spark, sf_small):
    fact = sales_fact(spark, sf_small)
    cube = sales_cube(fact)
    brute = _window_form(cell_aggregate(dedup_full_row(fact)))
    assert cube.exceptAll(brute).count() == 0
    assert brute.exceptAll(cube).count() == 0


def test_golden_window_form(spark):
    df = _csv(spark)
    assert _rows(_window_form(cell_aggregate(dedup_full_row(df)))) == _rows(sales_cube(df))


def test_independent_of_shuffle_partitions(spark, sf_small):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = _rows(sales_cube(sales_fact(spark, sf_small)))
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = _rows(sales_cube(sales_fact(spark, sf_small)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == many


def test_invariants(spark, sf_small):
    fact = sales_fact(spark, sf_small)
    cube = sales_cube(fact).cache()
    sums = cube.agg(*[F.sum(m).alias(m) for m in ("sum_amount", "count_sales", "sum_quantity")]) \
        .first()
    for dim, keys in DIMENSIONS.items():
        per_dim = cube.select(*keys, *[f"{m}_{dim}" for m in CELL_MEASURES]).distinct()
        # every roll-up is constant within its dimension value
        assert per_dim.count() == cube.select(*keys).distinct().count()
        totals = per_dim.agg(*[F.sum(f"{m}_{dim}").alias(m)
                               for m in ("sum_amount", "count_sales", "sum_quantity")]).first()
        assert totals == sums
    dated = dedup_full_row(fact).where(F.col("sale_date").isNotNull()).count()
    assert sums["count_sales"] == dated
    cube.unpersist()


def test_dedup_idempotent(spark, sf_small):
    fact = sales_fact(spark, sf_small)
    once = dedup_full_row(fact)
    twice = dedup_full_row(fact.unionAll(fact))
    assert once.count() == twice.count() == fact.count()
    assert once.exceptAll(twice).count() == 0


def test_null_date_cell_counts_zero(spark):
    cube = sales_cube(_csv(spark))
    null_cell = cube.where(F.col("sale_month").isNull()).first()
    assert null_cell["count_sales"] == 0
    assert null_cell["sum_amount"] == 500
    assert null_cell["sum_quantity"] == 2


def test_negative_amounts_round_away_from_zero(spark):
    rows = [(1, 1, 1, 1, None, 1.0, -10.05, "North"), (2, 1, 1, 1, None, 1.0, -10.0, "North")]
    df = spark.createDataFrame(rows, SALES_SCHEMA)
    r = sales_cube(df).first()
    # mean -10.025 -> -10.0; sum -20.05 -> -20.1 (half away) -> -20 (cast truncates)
    assert r["avg_receipt"] == -10.0
    assert r["sum_amount"] == -20


def test_empty_input(spark):
    df = spark.createDataFrame([], SALES_SCHEMA)
    cube = sales_cube(df)
    assert cube.columns == CUBE_COLUMNS
    assert cube.count() == 0


def test_cells_and_rollups_are_stored(spark, sf_small):
    fact = sales_fact(spark, sf_small)
    cube = sales_cube(fact)
    plan = cube._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and plan.count("Relation") == 4  # the cells and three roll-ups


def test_thousandths_add_up(spark):
    df = spark.range(1000).selectExpr(
        "id AS sale_id", "1 AS customer_id", "1 AS product_id", "1 AS quantity",
        "DATE '2024-05-01' AS sale_date", "1.0D AS price_product", "0.004D AS sale_amount", "'N' AS region")
    row = sales_cube(df).first()
    assert row.sum_amount == 4 and row.avg_receipt == 0.0 and row.sum_amount_region == 4
