"""Loading: rejects of the CSV reader, keys by range, de-duplication by digest, enforced lengths, message."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.operators import contracts, monitoring
from tillroll.operators.dedup import dedup_by_digest, dedup_full_row
from tillroll.plans.registry import QUERIES
from tillroll.schemas import ROWSTORE_SALES_TYPES, SALES_COLUMNS, SALES_SCHEMA
from tillroll.sources.files import read_sales_csv_rejects
from tillroll.sources.sinks import refresh_table
from tillroll.sources.testdata import table


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def write_lines(path, lines, header=",".join(SALES_COLUMNS)):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


# --- rejects

def test_rejects_with_reasons(spark, tmp_path):
    path = write_lines(tmp_path / "raw.csv", [
        "1,10,3,2,2025-01-02,5.5,11.0,North",
        "2,,3,2,,5.5,,",                                      # empty cells are nulls
        "3,10,3,two,2025-01-02,5.5,11.0,North",               # no number
        "4,10,3,2,02.01.2025,5.5,11.0,North",                 # no date
        "5,99999999999,3,2,2025-01-02,5.5,11.0,North",        # too large for an int
        "6,10,3,2,2025-01-02,5.5",                            # too few cells
        "7,10,3,2,2025-02-30,n/a,11.0,North",                 # two reasons
        "8, 10 ,3,2,2025-01-02,5.5,1e3,\"No,rth\"",
        "9,10,3,2,2025-01-02,5.5,11.0,North,more",            # too many cells
    ])
    good, bad = read_sales_csv_rejects(spark, path)
    assert good.schema.simpleString() == SALES_SCHEMA.simpleString()
    assert [tuple(r) for r in good.orderBy("sale_id").collect()] == [
        (1, 10, 3, 2, dt.date(2025, 1, 2), 5.5, 11.0, "North"), (2, None, 3, 2, None, 5.5, None, None),
        (8, 10, 3, 2, dt.date(2025, 1, 2), 5.5, 1000.0, "No,rth")]
    found = {r.cells[0]: r.reasons for r in bad.collect()}
    assert found == {
        "3": ["quantity: two is no int"], "4": ["sale_date: 02.01.2025 is no date"],
        "5": ["customer_id: 99999999999 is no int"], "6,10,3,2,2025-01-02,5.5": ["wrong number of cells"],
        "7": ["sale_date: 2025-02-30 is no date", "price_product: n/a is no double"],
        "9,10,3,2,2025-01-02,5.5,11.0,North,more": ["wrong number of cells"]}
    assert all(r.file.endswith("raw.csv") for r in bad.collect())


def test_reject_reader_refuses_another_header_and_reads_empty_files(spark, tmp_path):
    other = write_lines(tmp_path / "other.csv", ["1,1,1,1,2025-01-02,1,1,N"],
                        ",".join(reversed(SALES_COLUMNS)))
    with pytest.raises(Exception):
        read_sales_csv_rejects(spark, other)
    good, bad = read_sales_csv_rejects(spark, write_lines(tmp_path / "none.csv", []))
    assert good.count() == bad.count() == 0


# --- keys

def stored_keys(spark, tmp_path, name, df, clustered=True):
    path = str(tmp_path / name)
    (df.repartitionByRange(4, "sale_id") if clustered else df).write.parquet(path)
    return spark.read.parquet(path)


def plans_of(spark, run):
    """The result of ``run`` and the exchanges of the jobs' plans that the checks made."""
    found = []
    listener = contracts.stored

    def spy(df, name):
        found.append(df._jdf.queryExecution().executedPlan().toString())
        return listener(df, name)
    contracts.stored = spy
    try:
        return run(), found
    finally:
        contracts.stored = listener


def test_clustered_load_shuffles_no_key(spark, tmp_path):
    df = stored_keys(spark, tmp_path, "clean", spark.range(0, 600_000, 3).withColumnRenamed("id", "sale_id"))
    result, plans = plans_of(spark, lambda: contracts.pk_violations_by_range(df))
    assert result.count() == 0 and result.columns == ["sale_id", "n"]
    assert "hashpartitioning" not in result._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for p in plans for x in p.splitlines() if "Exchange hashpartitioning" in x]
    assert exchanges and all("hashpartitioning(_bucket" in x for x in exchanges)


@pytest.mark.parametrize("clustered", [True, False])
def test_violations_by_range(spark, tmp_path, clustered):
    base = spark.range(-100_000, 100_000).withColumnRenamed("id", "sale_id")
    extra = spark.createDataFrame([(5,), (5,), (99_999,), (-70_000,), (None,), (None,)], "sale_id long")
    df = stored_keys(spark, tmp_path, f"bad{clustered}", base.unionAll(extra), clustered)
    want = [(-70_000, 2), (5, 3), (99_999, 2), (None, 2)]
    assert rows(contracts.pk_violations_by_range(df)) == rows(contracts.pk_violations(df))
    assert rows(contracts.pk_violations_by_range(df)) == sorted(want, key=str)
    # few rows over a wide range: bitmaps would weigh more than the keys
    wide = stored_keys(spark, tmp_path, f"wide{clustered}", spark.range(50).selectExpr(
        "id % 40 * 1000000007 AS sale_id"), clustered)
    assert rows(contracts.pk_violations_by_range(wide)) == rows(contracts.pk_violations(wide))
    none = stored_keys(spark, tmp_path, f"none{clustered}", base.limit(0), clustered)
    assert contracts.pk_violations_by_range(none).count() == 0


# --- de-duplication

def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]


def test_dedup_by_digest(spark, sf_small, tmp_path):
    fact = QUERIES["sales_fact"](spark, sf_small)
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    clean = dedup_by_digest(fact)
    assert exchanges(clean) == [] and rows(clean) == rows(fact)  # digests alone were shuffled
    copies = fact.unionAll(fact.limit(500)).unionAll(fact.limit(20))
    copies.write.parquet(str(tmp_path / "copies"))
    copies = spark.read.parquet(str(tmp_path / "copies"))
    assert rows(dedup_by_digest(copies)) == rows(dedup_full_row(copies))
    assert rows(dedup_by_digest(copies, max_repeated=0)) == rows(fact)


def test_colliding_digests_keep_unlike_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (3, None), (None, "3"), (4, "")],
                               "k int, v string")
    same = lambda d: [F.lit(1).cast("long"), F.lit(2).cast("long")]
    halves = lambda d: [F.coalesce(F.col("k"), F.lit(0)).cast("long") % 2, F.lit(0).cast("long")]
    for digest in (same, halves):
        assert rows(dedup_by_digest(df, digest)) == rows(df.distinct())
    nulls = spark.createDataFrame([(None, "x"), ("x", None), (None, None), (None, None)], "a string, b string")
    assert rows(dedup_by_digest(nulls)) == rows(nulls.distinct())


# --- lengths and versions

def test_too_long_region_is_refused_by_the_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads_t")
    name = "loads_t.sales"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    row = (1, 1, 1, 1, dt.date(2025, 1, 2), 1.0, 2.0, "North")
    fits = spark.createDataFrame([row], SALES_SCHEMA)
    refresh_table(spark, fits, name, ROWSTORE_SALES_TYPES)
    with pytest.raises(Exception, match="(?i)length limitation"):  # the table itself, after the switch
        spark.sql(f"INSERT INTO {name} VALUES (2, 1, 1, 1, NULL, 1.0, 1.0, 'MIDDLE EAST')")
    with pytest.raises(Exception, match="(?i)length limitation"):
        refresh_table(spark, spark.createDataFrame([(*row[:-1], "MIDDLE EAST")], SALES_SCHEMA), name,
                      ROWSTORE_SALES_TYPES)
    assert [r.region for r in spark.read.table(name).collect()] == ["North"]
    assert [t.name for t in spark.catalog.listTables("loads_t") if not t.isTemporary] == ["sales"]


def test_readers_of_the_version_before_go_on(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads_v")
    name, types = "loads_v.nums", {"k": "bigint"}
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    new = lambda n: refresh_table(spark, spark.range(n).selectExpr("id AS k"), name, types)
    new(3)
    reader = spark.read.parquet(*spark.read.table(name).inputFiles())
    new(4)
    assert reader.count() == 3 and spark.read.table(name).count() == 4
    new(5)  # two refreshes later the first version is gone
    with pytest.raises(Exception):
        reader.select("k").collect()


# --- message

def test_message(spark):
    counts = spark.createDataFrame(
        [("b", "t2", 1234), ("b", "t1", None), ("a", "x", 5)], "source string, table_name string, row_count bigint")
    message = monitoring.row_count_message(counts, {"b": "Bee", "a": "Ay", "c": "Sea"}, "Head",
                                           F.lit("2025-01-02 03:04:05"))
    assert [r.message for r in message.collect()] == [
        "Head\n\n📅 Дата и время импорта: `2025-01-02 03:04:05`\n\n"
        "*Bee* (итого строк: `1,234`):\n  • `t1`: `unknown`\n  • `t2`: `1,234`\n\n"
        "*Ay* (итого строк: `5`):\n  • `x`: `5`\n\n"
        "*Sea* (итого строк: `0`):\n  • (нет таблиц)"]
    plain = monitoring.row_count_message(counts.limit(0), {"a": "Ay"}, "Head").first().message
    assert plain == "Head\n\n*Ay* (итого строк: `0`):\n  • (нет таблиц)"


def test_catalog_counts_of_partitioned_and_plain_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads_c")
    spark.range(42).write.mode("overwrite").saveAsTable("loads_c.plain")
    spark.range(30).selectExpr("id", "id % 3 AS p").write.mode("overwrite").partitionBy("p").saveAsTable(
        "loads_c.parts")
    got = monitoring.catalog_row_counts(spark, "s", "loads_c").collect()
    assert [(r.table_name, r.row_count) for r in got] == [("parts", 30), ("plain", 42)]


def test_shared_folder_is_asked_for_outside_local_mode(spark, monkeypatch):
    from tillroll import session

    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        sparkContext = Context()

    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: "hdfs://x/check/")
    assert session.shared_folder(Session()) == "hdfs://x/check/tillroll/app"
    assert table(spark, "/root/testdata/sf0.001", "region").count() == 5
