"""Row counts per table, totals, the text report and the latest import."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.text import thousands
from tillroll.session import configure

# Report line layout and the placeholder for a source with no
# tables, as the reference prints them.
LINE_PREFIX = "  • `"
LINE_MIDDLE = "`: `"
LINE_SUFFIX = "`"
NO_TABLES = "  • (нет таблиц)"
# Count of a table without statistics.
UNKNOWN = "unknown"


COUNTS_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("row_count", T.LongType()),
])


def row_counts(tables: dict[str, DataFrame], source: str) -> DataFrame:
    """(source, table_name, row_count) for each table: exact counts, all in
    one job (a union of global aggregates, one row a table), in table-name order."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(source).alias("source"), F.lit(name).alias("table_name"), "row_count")
        for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


#: A count needs no column; a given schema saves the job that would look for one.
NO_COLUMN = "_ int"


def footer_session(spark: SparkSession) -> SparkSession:
    """A sibling session (same application) whose Parquet reader answers ``count(*)`` from the
    files' footers: no row is read."""
    sibling = configure(spark.newSession())
    v1 = sibling.conf.get("spark.sql.sources.useV1SourceList").split(",")
    sibling.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in v1 if s != "parquet"))
    sibling.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return sibling


def parquet_row_counts(spark: SparkSession, paths: dict[str, str], source: str) -> DataFrame:
    """``row_counts`` of Parquet folders, from their metadata."""
    sibling = footer_session(spark)
    return row_counts({n: sibling.read.schema(NO_COLUMN).parquet(p) for n, p in paths.items()}, source)


def catalog_tables(spark, database: str | None = None,
                   exclude_types: tuple[str, ...] = ("VIEW", "MATERIALIZED_VIEW", "TEMPORARY")
                   ) -> list[str]:
    """Table names of a catalog database, without views, sorted. The list is
    catalog metadata (bounded by the number of tables), not data."""
    return sorted(t.name for t in spark.catalog.listTables(database)
                  if (t.tableType or "").upper() not in exclude_types and not t.isTemporary)


def catalog_row_counts(spark, source: str, database: str | None = None) -> DataFrame:
    """Exact counts of a database's tables; of unpartitioned Parquet tables from their footers."""
    names = catalog_tables(spark, database)
    if not names:
        return spark.createDataFrame([], COUNTS_SCHEMA)
    prefix = f"{database}." if database else ""
    sibling = footer_session(spark)

    def handle(name: str) -> DataFrame:
        rows = sibling.read.table(prefix + name)
        detail = {r.col_name: r.data_type
                  for r in spark.sql(f"DESCRIBE TABLE EXTENDED {prefix}{name}").collect()}
        if detail.get("Provider") != "parquet" or "Partition Provider" in detail:
            return rows
        return sibling.read.schema(NO_COLUMN).parquet(detail["Location"])

    return row_counts({n: handle(n) for n in names}, source)


def estimated_row_counts(spark, source: str, database: str | None = None) -> DataFrame:
    """(source, table_name, row_count) from the catalog's table statistics,
    without reading any data: the count last computed by ``ANALYZE TABLE``,
    null for a table never analysed. An estimate, like a store's live-row
    statistics; ``catalog_row_counts`` is the exact count."""
    prefix = f"{database}." if database else ""
    rows = []
    for name in catalog_tables(spark, database):
        stats = [r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {prefix}{name}").collect()
                 if r.col_name == "Statistics"]
        found = re.search(r"(\d+) rows", stats[0]) if stats else None
        rows.append((source, name, int(found.group(1)) if found else None))
    return spark.createDataFrame(rows, COUNTS_SCHEMA)


def row_count_totals(counts: DataFrame) -> DataFrame:
    """(source, total_rows); a null count adds 0."""
    return counts.groupBy("source").agg(
        F.sum(F.coalesce(F.col("row_count"), F.lit(0))).alias("total_rows"))


def report_line(name: Column, count: Column) -> Column:
    return F.concat(F.lit(LINE_PREFIX), name, F.lit(LINE_MIDDLE),
                    F.coalesce(thousands(count), F.lit(UNKNOWN)), F.lit(LINE_SUFFIX))


def row_count_report(counts: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """(source, total_rows, report): one text block per source, tables in name
    order, one line each. Grouped per source, so each group holds one row per
    table of that source (catalog-sized). Every name in ``sources`` gets a
    row, with the placeholder line when it has no tables."""
    if sources:
        spark = counts.sparkSession
        listed = spark.createDataFrame([(s, None, None) for s in sources], COUNTS_SCHEMA)
        counts = counts.unionByName(listed)
    grouped = counts.groupBy("source").agg(
        F.sum(F.coalesce(F.col("row_count"), F.lit(0))).alias("total_rows"),
        F.array_sort(F.collect_list(F.when(F.col("table_name").isNotNull(),
                                           F.struct("table_name", "row_count")))).alias("_t"),
    )
    lines = F.array_join(F.transform("_t", lambda t: report_line(t["table_name"],
                                                                 t["row_count"])), "\n")
    return grouped.select(
        "source", "total_rows",
        F.coalesce(F.nullif(lines, F.lit("")), F.lit(NO_TABLES)).alias("report"))


# The parts of the whole message.
STORE_LINE = ("*", "* (итого строк: `", "`):\n")
IMPORT_LINE = ("📅 Дата и время импорта: `", "`\n\n")


def row_count_message(counts: DataFrame, titles: dict[str, str], heading: str,
                      imported: Column | None = None) -> DataFrame:
    """(message): the whole report as one text: the heading, the time of the import (if given) and a
    block per store in the order of ``titles`` (source -> its title): title, total and one line
    a table. One row per store and catalog-sized blocks are what a task holds."""
    report = row_count_report(counts, list(titles))
    place = F.array_position(F.array(*map(F.lit, titles)), F.col("source"))
    title = F.element_at(F.array(*map(F.lit, titles.values())), place.cast("int"))
    block = F.concat(F.lit(STORE_LINE[0]), title, F.lit(STORE_LINE[1]), thousands(F.col("total_rows")),
                     F.lit(STORE_LINE[2]), F.col("report"))
    blocks = report.where(F.col("source").isin(list(titles))).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
            place.alias("place"), block.alias("block")))), lambda b: b["block"]), "\n\n").alias("blocks"))
    head = F.lit(f"{heading}\n\n")
    if imported is not None:
        head = F.concat(head, F.lit(IMPORT_LINE[0]), F.coalesce(imported, F.lit(UNKNOWN)),
                        F.lit(IMPORT_LINE[1]))
    return blocks.select(F.concat(head, F.col("blocks")).alias("message"))


def latest_import(warehouse_cube: DataFrame) -> DataFrame:
    return warehouse_cube.agg(F.max("import_date").alias("latest_import"))
