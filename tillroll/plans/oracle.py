"""DuckDB statements giving the same rows as ``tillroll.plans.registry``.

The cube statement uses window aggregates over the whole partition, the
reference's formulation, so it checks the Spark plan (aggregate and join
back) independently. Integer arithmetic as in ``functions.rounding``:
``//`` for ``div`` and a cast around every ``sum`` (DuckDB widens to
HUGEINT).
"""

from __future__ import annotations

from tillroll.plans.registry import AS_OF, BROKEN, SOURCE, STORES, TOP_K
from tillroll.schemas import CELL_MEASURES, CUBE_KEYS, DIMENSIONS, cube_types, value_type
from tillroll.sources.testdata import TABLES


def half_up(num: str, den: str) -> str:
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


FINE_AMOUNT = ("CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) "
               "* (1 + CAST(l.l_tax AS DECIMAL(4,2))) AS DOUBLE)")


def fact_sql(grain: str = "brand", amount: str = "l.l_extendedprice") -> str:
    pid = ("CAST(regexp_extract(p.p_brand, '([0-9]+)', 1) AS INTEGER)" if grain == "brand"
           else "p.p_partkey")
    return f"""
    SELECT l.l_orderkey * 10 + l.l_linenumber AS sale_id,
           o.o_custkey AS customer_id,
           {pid} AS product_id,
           CAST(l.l_quantity AS INTEGER) AS quantity,
           CAST(l.l_shipdate AS DATE) AS sale_date,
           p.p_retailprice AS price_product,
           {amount} AS sale_amount,
           r.r_name AS region
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    JOIN part p ON l.l_partkey = p.p_partkey"""


def cells_sql(rows: str, unit: int = 100) -> str:
    """Cells of the distinct rows of ``rows`` (a statement), with r10 / q10. Amounts are summed as
    whole counts of ``1 / unit``."""
    tenth = unit // 10
    receipt10 = half_up("cents", f"nullif(n_amount, 0) * {tenth}")
    quantity10 = half_up("sum_quantity * 10", "nullif(n_quantity, 0)")
    return f"""
    SELECT region, product_id, sale_month, num_month, sale_year,
           {receipt10} / 10.0::DOUBLE AS avg_receipt,
           sign(cents) * (((2 * abs(cents) + {tenth}) // {2 * tenth}) // 10) AS sum_amount,
           count_sales, sum_quantity,
           {quantity10} / 10.0::DOUBLE AS avg_receipt_quantity,
           {receipt10} AS r10, {quantity10} AS q10
    FROM (
      SELECT region, product_id,
             monthname(sale_date) AS sale_month,
             CAST(month(sale_date) AS INTEGER) AS num_month,
             CAST(year(sale_date) AS INTEGER) AS sale_year,
             CAST(sum(CAST(round(sale_amount * {unit}) AS BIGINT)) AS BIGINT) AS cents,
             count(sale_amount) AS n_amount,
             count(sale_date) AS count_sales,
             CAST(sum(quantity) AS BIGINT) AS sum_quantity,
             count(quantity) AS n_quantity
      FROM (SELECT DISTINCT * FROM ({rows}))
      GROUP BY ALL)"""


def rollup_select(dim: str) -> str:
    w = f"OVER (PARTITION BY {', '.join(DIMENSIONS[dim])})"
    return f""",
           {half_up(f'sum(r10) {w}', f'nullif(count(r10) {w}, 0)')} / 10.0::DOUBLE
             AS avg_receipt_{dim},
           CAST(sum(sum_amount) {w} AS BIGINT) AS sum_amount_{dim},
           CAST(sum(count_sales) {w} AS BIGINT) AS count_sales_{dim},
           CAST(sum(sum_quantity) {w} AS BIGINT) AS sum_quantity_{dim},
           {half_up(f'sum(q10) {w}', f'nullif(count(q10) {w}, 0)')} / 10.0::DOUBLE
             AS avg_receipt_quantity_{dim}"""


def cube_sql(rows: str, dims=None, **kw) -> str:
    dims = list(DIMENSIONS) if dims is None else dims
    cols = ", ".join(CUBE_KEYS + CELL_MEASURES)
    return f"SELECT {cols}{''.join(rollup_select(d) for d in dims)} FROM ({cells_sql(rows, **kw)})"


FACT = fact_sql()
CUBE = cube_sql(FACT)
UNDATED = f"SELECT * REPLACE (CASE WHEN sale_id % 7 <> 0 THEN sale_date END AS sale_date) FROM ({FACT})"
AS_OF_SQL = f"DATE '{AS_OF.isoformat()}'"

TOP_METRICS = {"receipt": ("avg_receipt_product_id", "avg_receipt"),
               "amount": ("sum_amount_product_id", "amount")}


def top_sql(metric: str, months: int) -> str:
    column, alias = TOP_METRICS[metric]
    target = f"({AS_OF_SQL} - INTERVAL {months} MONTH)" if months else AS_OF_SQL
    return f"""
    SELECT DISTINCT product_id, {column} AS {alias}
    FROM ({cube_sql(FACT, ['product_id'])})
    WHERE sale_month = monthname({target}) AND sale_year = year({AS_OF_SQL})
    ORDER BY {alias} DESC, product_id
    LIMIT {TOP_K}"""


def chart_sql(metric: str) -> str:
    _, v = TOP_METRICS[metric]
    fv = f"CAST({v} AS DOUBLE)"
    return f"""
    SELECT product_id, {v}, rank, CAST(n + 1 - rank AS BIGINT) AS display_pos,
           CAST(product_id AS VARCHAR) AS product_label,
           CASE WHEN {v} >= 1e6 THEN format('{{:.2f}}M', {fv} / 1e6)
                ELSE format('{{:,.1f}}', {fv}) END AS value_label,
           CASE WHEN {v} >= 1e6 THEN format('{{:.1f}}M', {fv} / 1e6)
                ELSE format('{{:,.0f}}', {fv}) END AS axis_label,
           coalesce(mx, 1) * 1.18::DOUBLE AS axis_max,
           {v} + mx * 0.01::DOUBLE AS label_x
    FROM (SELECT *, CAST(row_number() OVER (ORDER BY {v} DESC, product_id) AS INTEGER) AS rank,
                 count(*) OVER () AS n, max({v}) OVER () AS mx
          FROM ({top_sql(metric, 0)}))"""


ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{SOURCE}' AS source, '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in TABLES)


def dashboard_sql(dim: str, extra: str = "") -> str:
    keys = ", ".join(DIMENSIONS[dim])
    cols = ", ".join(f"{m}_{dim}" for m in CELL_MEASURES)
    return f"SELECT DISTINCT {keys}{extra}, {cols} FROM ({CUBE})"


def dashboard_all_sql() -> str:
    receipt = half_up("sum(r10)", "nullif(count(r10), 0)")
    quantity = half_up("sum(q10)", "nullif(count(q10), 0)")
    return f"""
    SELECT CASE g WHEN 7 THEN 'region' WHEN 11 THEN 'product_id' WHEN 12 THEN 'month_year' ELSE 'total' END
             AS dim,
           region, product_id, sale_month, sale_year, CASE WHEN g = 12 THEN nm END AS num_month,
           avg_receipt, sum_amount, count_sales, sum_quantity, avg_receipt_quantity
    FROM (
      SELECT grouping_id(region, product_id, sale_month, sale_year) AS g,
             region, product_id, sale_month, sale_year, max(num_month) AS nm,
             {receipt} / 10.0::DOUBLE AS avg_receipt, CAST(sum(sum_amount) AS BIGINT) AS sum_amount,
             CAST(sum(count_sales) AS BIGINT) AS count_sales,
             CAST(sum(sum_quantity) AS BIGINT) AS sum_quantity,
             {quantity} / 10.0::DOUBLE AS avg_receipt_quantity
      FROM ({cells_sql(FACT)})
      GROUP BY GROUPING SETS ((region), (product_id), (sale_month, sale_year), ()))"""


def csv_rejects_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, count(*) AS n_rows FROM ({FACT}) WHERE {cond} HAVING count(*) > 0"
             for c, (cond, _) in BROKEN.items()]
    good = " AND ".join(f"NOT ({cond})" for cond, _ in BROKEN.values())
    return " UNION ALL ".join([f"SELECT '-' AS column_name, count(*) AS n_rows FROM ({FACT}) WHERE {good}",
                               *parts])


def message_sql() -> str:
    blocks = []
    for store, tables in STORES.items():
        counts = " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM {t}" for t in tables)
        blocks.append(f"""(SELECT '*{store.title()}* (итого строк: `' || format('{{:,}}', CAST(sum(n) AS BIGINT))
          || '`):' || chr(10) || string_agg('  • `' || t || '`: `' || format('{{:,}}', n) || '`', chr(10)
          ORDER BY t) FROM ({counts}))""")
    return f"""SELECT 'Rows' || chr(10) || chr(10) || '📅 Дата и время импорта: `'
      || (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM events) || '`' || chr(10) || chr(10)
      || {" || chr(10) || chr(10) || ".join(blocks)} AS message"""


def _typed_cube(store: str, import_date: str | None) -> str:
    types = cube_types(store)
    cols = []
    for c, t in types.items():
        if c == "import_date":
            cols.append(f"CAST({import_date} AS DATE) AS import_date")
        else:
            cols.append(f"CAST({c} AS {value_type(t).upper().replace('STRING', 'VARCHAR')}) AS {c}")
    return f"SELECT {', '.join(cols)} FROM ({CUBE})"


_NULLS_FOR_ROLLUPS = ", ".join(
    f"CAST(NULL AS {'DOUBLE' if m.startswith('avg') else 'BIGINT'}) AS {m}_{d}"
    for d in DIMENSIONS for m in CELL_MEASURES)

_CELLS_10 = f"SELECT {', '.join(CUBE_KEYS + CELL_MEASURES)} FROM ({cells_sql(FACT)})"

ORACLE_SQL: dict[str, str] = {
    "sales_cube": CUBE,
    "sales_fact": FACT,
    "date_parts": f"""SELECT DISTINCT sale_date, monthname(sale_date) AS sale_month,
        CAST(month(sale_date) AS INTEGER) AS num_month,
        CAST(year(sale_date) AS INTEGER) AS sale_year FROM ({FACT})""",
    "dedup_full_row": f"SELECT DISTINCT * FROM ({FACT} UNION ALL {FACT})",
    "cell_aggregate": _CELLS_10,
    "rollup_region": cube_sql(FACT, ["region"]),
    "rollup_month_year": cube_sql(FACT, ["month_year"]),
    "rollup_product": cube_sql(FACT, ["product_id"]),
    "sales_cube_part_grain": cube_sql(fact_sql("part")),
    "sales_cube_fine": cube_sql(fact_sql(amount=FINE_AMOUNT), unit=1_000_000),
    "sales_cube_twice": cube_sql(f"{FACT} UNION ALL {FACT}"),
    "sales_cube_undated": cube_sql(UNDATED),
    "dedup_by_digest": f"SELECT DISTINCT * FROM ({FACT})",
    "top10_stored_receipt_cur": top_sql("receipt", 0),
    "top10_stored_amount_cur": top_sql("amount", 0),
    "top10_stored_amount_prev": top_sql("amount", 1),
    "top10_stored_receipt_prev": top_sql("receipt", 1),
    "top10_receipt_cur": top_sql("receipt", 0),
    "top10_amount_cur": top_sql("amount", 0),
    "top10_amount_prev": top_sql("amount", 1),
    "top10_receipt_prev": top_sql("receipt", 1),
    "distinct_product_metric": f"""SELECT DISTINCT product_id,
        avg_receipt_product_id AS avg_receipt FROM ({cube_sql(FACT, ['product_id'])})""",
    "row_counts": ROW_COUNTS,
    "row_counts_total": f"""SELECT source, CAST(sum(coalesce(row_count, 0)) AS BIGINT) AS total_rows
        FROM ({ROW_COUNTS}) GROUP BY source""",
    "row_counts_report": f"""SELECT source, CAST(sum(coalesce(row_count, 0)) AS BIGINT) AS total_rows,
        coalesce(nullif(string_agg('  • `' || table_name || '`: `'
                                   || format('{{:,}}', coalesce(row_count, 0)) || '`',
                                   chr(10) ORDER BY table_name), ''),
                 '  • (нет таблиц)') AS report
        FROM ({ROW_COUNTS}) GROUP BY source""",
    "row_counts_message": message_sql(),
    "latest_import": f"""SELECT max(CASE WHEN sale_year = {AS_OF.year} THEN {AS_OF_SQL}
                                ELSE CAST({AS_OF_SQL} - INTERVAL 7 DAY AS DATE) END) AS latest_import
        FROM ({CUBE})""",
    "not_in_filter": """SELECT event_type, count(*) AS n FROM events
        WHERE event_type NOT IN ('error', 'signup') GROUP BY event_type""",
    "load_contract_sales": f"""SELECT CAST(sale_id AS BIGINT) AS sale_id,
        CAST(customer_id AS INTEGER) AS customer_id, CAST(product_id AS INTEGER) AS product_id,
        CAST(quantity AS INTEGER) AS quantity, CAST(sale_date AS DATE) AS sale_date,
        CAST(price_product AS DECIMAL(10,2)) AS price_product,
        CAST(sale_amount AS DECIMAL(12,2)) AS sale_amount, region,
        length(region) <= 10 AS region_fits
        FROM ({FACT})""",
    "load_contract_rowstore": f"""SELECT *, length(region) <= 10 AS region_fits
        FROM ({_typed_cube("rowstore", None)})""",
    "load_contract_warehouse": _typed_cube("warehouse", AS_OF_SQL),
    "pk_violations": """SELECT sale_id, n FROM (
        SELECT l_orderkey * 10 + l_linenumber AS sale_id, count(*) AS n FROM lineitem GROUP BY 1)
        WHERE n > 1 OR sale_id IS NULL""",
    "pk_violations_by_range": """SELECT sale_id, n FROM (
        SELECT l_orderkey * 10 + l_linenumber AS sale_id, count(*) AS n FROM lineitem GROUP BY 1)
        WHERE n > 1 OR sale_id IS NULL""",
    "csv_rejects": csv_rejects_sql(),
    "schema_evolution": f"""SELECT *, {_NULLS_FOR_ROLLUPS} FROM ({_CELLS_10})
        UNION ALL BY NAME {CUBE}""",
    "orders_lookup": """SELECT c_custkey, n_orders FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
    "price_lookup": """SELECT l_orderkey, l_linenumber, l_partkey, p_retailprice
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "sale_amount_derived": """SELECT l_orderkey, l_linenumber,
        CAST(round(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)), 2)
             AS DECIMAL(12,2)) AS sale_amount
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "clip_quantity": """SELECT l_returnflag,
        CAST(sum(least(greatest(CAST(l_quantity AS INTEGER), 5), 30)) AS BIGINT) AS clipped_quantity
        FROM lineitem GROUP BY l_returnflag""",
    "epoch_to_date": """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
        CAST(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS DATE) AS event_date
        FROM events""",
    "chart_labels_receipt": chart_sql("receipt"),
    "chart_labels_amount": chart_sql("amount"),
    "dashboard_region": dashboard_sql("region"),
    "dashboard_product": dashboard_sql("product_id"),
    "dashboard_period": dashboard_sql("month_year", ", num_month"),
    "dashboard_all": dashboard_all_sql(),
    "ts_text": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events",
}
