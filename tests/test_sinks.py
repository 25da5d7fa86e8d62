"""Sinks and sources: CSV round trip, Parquet, table full refresh, sort key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.schemas import SALES_COLUMNS, cube_types
from tillroll.sources.files import read_sales, read_sales_csv
from tillroll.sources.generator import generate_sales
from tillroll.sources.sinks import refresh_table, write_parquet, write_sales_csv
from tillroll.plans.cube import sales_cube


def test_csv_round_trip(spark, tmp_path):
    g = generate_sales(spark, 2000, dt.date(2025, 1, 10), num_partitions=3)
    write_sales_csv(g, str(tmp_path / "raw"))
    back = read_sales_csv(spark, str(tmp_path / "raw"))
    assert back.columns == SALES_COLUMNS
    assert back.count() == g.count()
    cast = g.select(*[F.col(c).cast(t) for c, t in back.dtypes])
    assert cast.exceptAll(back).count() == 0
    inferred = read_sales_csv(spark, str(tmp_path / "raw"), infer_schema=True)
    assert dict(inferred.dtypes)["sale_date"] == "date"
    assert dict(inferred.dtypes)["sale_amount"] == "double"


def test_parquet_clustered_write(spark, tmp_path):
    cube = sales_cube(generate_sales(spark, 3000, dt.date(2025, 1, 10)))
    path = str(tmp_path / "cube")
    write_parquet(cube, path, cluster_by=["sale_year", "num_month"])
    back = read_sales(spark, path)
    assert back.count() == cube.count()
    assert back.exceptAll(cube).count() == 0
    # every file holds a sorted run of (sale_year, num_month)
    runs = back.withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.collect_list(F.struct("sale_year", "num_month")).alias("keys")).collect()
    for r in runs:
        keys = [tuple(k) for k in r.keys]
        assert keys == sorted(keys)


def test_refresh_table_is_full_refresh_with_evolution(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks_t")
    t = "sinks_t.cube"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    # an older table with only keys and cell measures, plus a retired column
    spark.sql(f"CREATE TABLE {t} (region string, product_id int, sale_month string, "
              "num_month int, sale_year int, avg_receipt decimal(12,1), sum_amount bigint, "
              "count_sales bigint, sum_quantity bigint, avg_receipt_quantity decimal(6,1), "
              "retired string) USING parquet")
    spark.sql(f"INSERT INTO {t} (region) VALUES ('stale')")
    cube = sales_cube(generate_sales(spark, 3000, dt.date(2025, 1, 10)))
    types = cube_types("rowstore")
    refresh_table(spark, cube, t, types)
    refresh_table(spark, cube, t, types)  # twice: still one copy
    stored = spark.read.table(t)
    assert stored.count() == cube.count()
    assert stored.where("region = 'stale'").count() == 0
    assert stored.columns[:10] == list(types)[:10] and "retired" in stored.columns
    assert set(types) <= set(stored.columns)
    assert stored.where("retired IS NOT NULL").count() == 0
    assert dict(stored.dtypes)["avg_receipt_region"] == "decimal(12,1)"


def test_refresh_from_itself_and_failed_write_keeps_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks_swap")
    t = "sinks_swap.nums"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    types = {"k": "bigint", "v": "string"}
    refresh_table(spark, spark.range(10).selectExpr("id AS k", "CAST(id AS STRING) AS v"), t, types)
    # a new version computed from the table it replaces
    refresh_table(spark, spark.read.table(t).where("k < 5"), t, types)
    assert spark.read.table(t).count() == 5
    # a write that fails half way leaves the old rows
    bad = spark.range(10).selectExpr("id AS k", "CAST(id AS STRING) AS v").withColumn(
        "k", F.expr("CASE WHEN k = 7 THEN CAST(raise_error('boom') AS BIGINT) ELSE k END"))
    try:
        refresh_table(spark, bad, t, types)
    except Exception:
        pass
    assert sorted(r.k for r in spark.read.table(t).collect()) == [0, 1, 2, 3, 4]


def test_read_sales_formats(spark, tmp_path):
    g = generate_sales(spark, 1000, dt.date(2025, 1, 10))
    g.write.mode("overwrite").orc(str(tmp_path / "orc"))
    assert read_sales(spark, str(tmp_path / "orc"), fmt="orc").exceptAll(g).count() == 0
    spark.sql("CREATE DATABASE IF NOT EXISTS read_t")
    g.write.mode("overwrite").saveAsTable("read_t.raw")
    assert read_sales(spark, "read_t.raw", fmt="table").count() == g.count()
    write_sales_csv(g, str(tmp_path / "csv"))
    assert read_sales(spark, str(tmp_path / "csv"), fmt="csv").count() == g.count()


def test_refresh_stopped_at_any_step_keeps_rows(spark, monkeypatch):
    from tillroll.sources import sinks
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks_stop")
    t, types = "sinks_stop.nums", {"k": "bigint"}
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    rows = lambda n: spark.range(n).selectExpr("id AS k")
    stored = lambda: spark.read.table(t).count()
    refresh_table(spark, rows(5), t, types)

    def stop(*_):
        raise KeyboardInterrupt

    for step, left in (("_switch", 5), ("_remove", 7)):  # before and after the switch
        with monkeypatch.context() as m:
            m.setattr(sinks, step, stop)
            with pytest.raises(KeyboardInterrupt):
                refresh_table(spark, rows(7), t, types)
        assert stored() == left
        refresh_table(spark, rows(left), t, types)  # the next run goes on
        assert stored() == left
    with pytest.raises(ValueError):  # a failed check after the write
        refresh_table(spark, rows(9), t, types, check=lambda df: (_ for _ in ()).throw(ValueError()))
    assert stored() == 7


def test_strict_csv(spark, tmp_path):
    head = ",".join(SALES_COLUMNS)
    good = "1,10,3,2,2025-01-02,5.5,11.0,North"

    def read(name, lines, **options):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return read_sales(spark, str(path), fmt="csv", **options).collect()

    assert read("good.csv", [head, good])[0].customer_id == 10
    assert read("semi.csv", [head.replace(",", ";"), good.replace(",", ";")], sep=";")[0].product_id == 3
    swapped = head.replace("customer_id", "x").replace("product_id", "customer_id").replace("x", "product_id")
    for name, lines in (("head.csv", [swapped, good]), ("cell.csv", [head, good.replace(",2,", ",x,")]),
                        ("amount.csv", [head, good.replace("11.0", "abc")])):
        with pytest.raises(Exception):
            read(name, lines)


def test_amounts_beyond_cents_are_refused(spark):
    from tillroll.operators.contracts import whole_cents
    ok = spark.createDataFrame([(20.66,), (None,), (-3.0,)], "sale_amount double")
    assert whole_cents(ok).agg(F.sum("sale_amount")).first()[0] == 17.66
    with pytest.raises(Exception, match="more than two decimals"):
        whole_cents(spark.range(1000).selectExpr("0.004D AS sale_amount")).collect()
