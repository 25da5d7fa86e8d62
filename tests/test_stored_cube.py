"""The stored cube: freshness, data skipping by month, and the views in one pass."""

import datetime as dt
import pathlib
import shutil

import pytest

from tillroll.operators.cells import cells_with_tenths
from tillroll.operators.presentation import dashboard_period, dashboard_product, dashboard_region
from tillroll.operators.rollups import TOTAL, grouped_rollups
from tillroll.operators.topk import top_products, top_products_sql
from tillroll.plans import stored as stored_plan
from tillroll.plans.cube import sales_cube
from tillroll.schemas import CELL_MEASURES, CUBE_COLUMNS, DIMENSIONS
from tillroll.sources.sinks import read_cube, write_cube
from tillroll.sources.testdata import sales_fact


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def undated(spark, sf_small):
    return sales_fact(spark, sf_small).selectExpr(
        "* EXCEPT (sale_date)", "CASE WHEN sale_id % 5 <> 0 THEN sale_date END AS sale_date")


def test_round_trip_with_undated_sales(spark, undated, tmp_path):
    cube = sales_cube(undated)
    write_cube(cube, str(tmp_path / "cube"))
    back = read_cube(spark, str(tmp_path / "cube"))
    assert back.columns == CUBE_COLUMNS and back.dtypes == cube.dtypes
    assert back.where("num_month IS NULL").count() > 0
    assert rows(back) == rows(cube)


def test_other_months_are_not_read(spark, sf_small, tmp_path):
    path = tmp_path / "cube"
    cube = sales_cube(sales_fact(spark, sf_small))
    write_cube(cube, str(path))
    day = dt.date(2001, 10, 15)
    want = {(m, k): [tuple(r) for r in top_products(cube, m, day, k).collect()]
            for m in ("receipt", "amount") for k in (0, 1)}
    kept = {"sale_year=2001/num_month=10", "sale_year=2001/num_month=9"}
    spoilt = 0
    for part in path.glob("sale_year=*/num_month=*/*.parquet"):
        if str(part.parent.relative_to(path)) not in kept:
            part.write_bytes(b"not parquet")  # whoever opens it fails
            part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
            spoilt += 1
    assert spoilt > 50
    read_cube(spark, str(path)).createOrReplaceTempView("spoilt_cube")
    for (metric, months), top in want.items():
        got = top_products_sql(spark, "spoilt_cube", metric, day, months)
        assert [tuple(r) for r in got.collect()] == top and len(top) == 10
    with pytest.raises(Exception):
        read_cube(spark, str(path)).count()
        read_cube(spark, str(path)).select("region").collect()


def test_a_changed_source_is_another_cube(spark, sf_small, tmp_path, monkeypatch):
    for f in pathlib.Path(sf_small).glob("*.parquet"):
        shutil.copy(f, tmp_path / f.name)
    writes = []
    write = stored_plan.write_cube
    monkeypatch.setattr(stored_plan, "write_cube", lambda c, p: (writes.append(p), write(c, p)))
    first = rows(stored_plan.stored_cube(spark, str(tmp_path)))
    assert rows(stored_plan.stored_cube(spark, str(tmp_path))) == first and len(writes) == 1
    half = spark.read.parquet(f"{sf_small}/lineitem.parquet").where("l_orderkey % 2 = 0")
    (tmp_path / "lineitem.parquet").unlink()
    half.write.parquet(str(tmp_path / "lineitem.parquet"))
    assert rows(stored_plan.stored_cube(spark, str(tmp_path))) != first
    assert len(set(writes)) == 2


def test_views_are_slices_of_one_pass(spark, undated):
    cells = cells_with_tenths(undated)
    grouped = grouped_rollups(cells, [*DIMENSIONS, TOTAL])
    views = {"region": (dashboard_region, ["region"]), "product_id": (dashboard_product, ["product_id"]),
             "month_year": (dashboard_period, ["sale_month", "sale_year", "num_month"])}
    for dim, (view, keys) in views.items():
        part = grouped.where(f"dim = '{dim}'").select(*keys, *CELL_MEASURES)
        assert rows(part) == rows(view(cells))
    total = grouped.where("dim = 'total'").first()
    facts = undated.distinct().selectExpr("sum(quantity)", "count(sale_date)").first()
    assert (total.sum_quantity, total.count_sales) == tuple(facts)
    scans = grouped._jdf.queryExecution().optimizedPlan().toString().count("lineitem")
    assert scans <= 1
    assert rows(grouped_rollups(cells.limit(0), [*DIMENSIONS])) == []
