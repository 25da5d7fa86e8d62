"""Sources and sinks: files, tables, JDBC, the seeded generator and the
sales fact adapter over the test tables."""

from tillroll.sources.files import read_jdbc, read_sales, read_sales_csv  # noqa: F401
from tillroll.sources.generator import generate_sales, price_list  # noqa: F401
from tillroll.sources.testdata import TABLES, sales_fact, table  # noqa: F401
