"""Type and key contracts of the stores, and additive schema evolution."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import REGION_MAX_LENGTH, ROWSTORE_SALES_TYPES, cube_types, ddl, value_type
from tillroll.session import stored


def cast_to(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Select ``types``' columns in its order, cast to its types. ANSI casts:
    a value that does not fit raises instead of turning null."""
    return df.select(*[F.col(c).cast(value_type(t)).alias(c) for c, t in types.items()])


def sales_contract(sales: DataFrame) -> DataFrame:
    """Raw sales in the row store's types, plus ``region_fits``: whether the
    region fits the store's VARCHAR(10). The store would refuse such a row;
    here it is flagged so the whole batch can be checked before loading."""
    return cast_to(sales, ROWSTORE_SALES_TYPES).withColumn(
        "region_fits", F.length("region") <= REGION_MAX_LENGTH)


def rowstore_cube(cube: DataFrame) -> DataFrame:
    """The cube in the row store's types, means as decimal(12,1) / (6,1), plus
    ``region_fits`` as in ``sales_contract``."""
    return cast_to(cube, cube_types("rowstore")).withColumn(
        "region_fits", F.length("region") <= REGION_MAX_LENGTH)


def warehouse_cube(cube: DataFrame, import_date=None) -> DataFrame:
    """The warehouse copy: 25 cube columns plus ``import_date`` (the load
    day; ``current_date()`` unless given), in the warehouse's column order."""
    if import_date is None:
        day = F.current_date()
    elif isinstance(import_date, (_dt.date, str)):
        day = F.lit(import_date).cast("date")
    else:
        day = import_date
    return cast_to(cube.withColumn("import_date", day), cube_types("warehouse"))


def whole_cents(sales: DataFrame, column: str = "sale_amount") -> DataFrame:
    """``sales`` unchanged; reading an amount with more than two decimals raises (the cube
    sums whole cents, and a cut must not pass in silence)."""
    exact = F.col(column).cast("decimal(38,6)")
    return sales.withColumn(column, F.when(
        exact != F.round(exact, 2),
        F.raise_error(F.concat(F.lit(f"{column} has more than two decimals: "), exact.cast("string")))
        .cast(sales.schema[column].dataType)).otherwise(F.col(column)))


def pk_violations(df: DataFrame, key: str = "sale_id") -> DataFrame:
    """Keys that break a primary key: (key, n) for keys seen more than once,
    and one row with a null key if any key is null. Empty means the key holds.
    Counting is a partial + final aggregate, so a hot key costs nothing extra."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") > 1) | F.col(key).isNull())


#: Bytes of a bitmap of one bucket of Spark's ``bitmap_*`` functions, and of a key in a shuffle.
BITMAP_BYTES, KEY_BYTES = 4096, 8


def pk_violations_by_range(df: DataFrame, key: str = "sale_id") -> DataFrame:
    """``pk_violations`` of an integer key (SQL text over the columns of ``df``, which reads files)
    without a shuffle of the keys, where the files hold narrow key ranges.

    One aggregate gives each file's key range. Where the ranges are narrow, every range of
    32,768 keys gets the number of its rows and the bitmap of its keys, combined in the tasks
    before the shuffle: a range has a repeated key exactly if it has more rows than bits. Only rows
    of such ranges are grouped by key. Where the files' ranges are so wide that
    the bitmaps would outweigh the keys, the keys are grouped as they are.
    """
    spark = df.sparkSession
    value = F.expr(key)
    out = key if key.isidentifier() else "key"
    files = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(value).alias("least"), F.max(value).alias("most"), F.count(value).alias("n"),
        F.count_if(value.isNull()).alias("nulls")).selectExpr(
        "sum(n) AS n", "sum(nulls) AS nulls",
        "sum(bitmap_bucket_number(most) - bitmap_bucket_number(least) + 1) AS buckets").first()
    keys = df.select(value.alias(out))
    if not files["n"] or files["buckets"] * BITMAP_BYTES > files["n"] * KEY_BYTES:
        return pk_violations(keys, out)
    filled = keys.where(F.col(out).isNotNull()).withColumn("_bucket", F.bitmap_bucket_number(out))
    ranges = filled.groupBy("_bucket").agg(
        F.count("*").alias("n"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(out))).alias("bits"))
    repeated = stored(ranges.where("n > bits").select("_bucket"), "key-ranges")
    kind = keys.schema[out].dataType.simpleString()
    found = spark.createDataFrame([(None, files["nulls"])] if files["nulls"] else [],
                                  f"{out} {kind}, n bigint")
    if repeated.isEmpty():
        return found
    return pk_violations(filled.join(repeated, "_bucket").select(out), out).union(found)


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows written before and after columns were added: by name, with the
    missing columns null."""
    return old.unionByName(new, allowMissingColumns=True)


def create_table_if_absent(spark: SparkSession, table: str, types: dict[str, str],
                           fmt: str = "parquet", partitioned_by: list[str] | None = None) -> None:
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl(types)}) USING {fmt}{parts}")


def add_missing_columns(spark: SparkSession, table: str, types: dict[str, str]) -> list[str]:
    """Additive evolution: add the columns of ``types`` the table lacks.
    Existing columns are never dropped or retyped. Returns the added names."""
    have = {c.lower() for c in spark.read.table(table).columns}
    missing = {c: t for c, t in types.items() if c.lower() not in have}
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl(missing)})")
    return list(missing)
