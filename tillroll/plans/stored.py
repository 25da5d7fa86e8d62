"""The cube of the test tables as a store: written once per state of its sources, then queried."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans.cube import sales_cube
from tillroll.session import file_system, shared_folder
from tillroll.sources.sinks import read_cube, write_cube
from tillroll.sources.testdata import SCHEMAS, sales_fact


def source_state(spark: SparkSession, paths: list[str]) -> str:
    """Digest of the names, lengths and times of the files under ``paths`` (one listing each)."""
    found = []
    for path in paths:
        fs, at = file_system(spark, path)
        for status in fs.listStatus(at):
            found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.md5("\n".join([*paths, *sorted(found)]).encode()).hexdigest()


def stored_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube of the star tables, read from its folders by month. It is written where
    this application has none of the sources' present state: a changed source file means another
    folder, so a stored cube is never older than its sources."""
    state = source_state(spark, [f"{sf_dir}/{t}.parquet" for t in sorted(SCHEMAS)])
    path = f"{shared_folder(spark)}/cubes/{state}"
    fs, done = file_system(spark, f"{path}/_SUCCESS")
    if not fs.exists(done):
        write_cube(sales_cube(sales_fact(spark, sf_dir)), path)
    return read_cube(spark, path)
