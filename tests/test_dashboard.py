"""Dashboard views and templated SQL with bound parameters."""

from tillroll.operators.cells import cells_with_tenths
from tillroll.operators.dedup import dedup_full_row
from tillroll.operators.presentation import (dashboard_period, dashboard_product,
                                             dashboard_query, dashboard_region)
from tillroll.sources.testdata import sales_fact


def test_templated_filter(spark, sf_small):
    cells = cells_with_tenths(dedup_full_row(sales_fact(spark, sf_small)))
    views = {"by_region": dashboard_region(cells), "by_product": dashboard_product(cells),
             "by_period": dashboard_period(cells)}
    one = dashboard_query(spark, views, "SELECT * FROM by_region WHERE region = :region",
                          region="ASIA").collect()
    assert [r.region for r in one] == ["ASIA"]
    # a value is bound, never pasted into the text
    none = dashboard_query(spark, views, "SELECT * FROM by_region WHERE region = :region",
                           region="ASIA' OR '1'='1").collect()
    assert none == []
    year = dashboard_query(spark, views,
                           "SELECT count(*) AS n FROM by_period WHERE sale_year = :y", y=2000)
    assert year.first().n == 12
