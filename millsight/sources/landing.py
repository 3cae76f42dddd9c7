"""Landing-zone files: scans with file lineage, the source inventory, exports."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millsight.contracts import LOAD_ORDER


def _files(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}*.parquet"


def list_files(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """(_source_file, path) of one table's files; their content is not read."""
    listed = spark.read.format("binaryFile").load(_files(folder, table))
    return listed.select(F.col("_metadata.file_path").alias("_source_file"), "path")


def scan_files(
    spark: SparkSession, folder: str, table: str, paths: Sequence[str] | None = None
) -> DataFrame:
    """Parquet files of one table with their union schema and a ``_source_file`` column.

    Reads all files of the table, or just ``paths``; the schema is always that of all files, so a
    column that a new file lacks is a column of NULLs wherever another file has it.
    """
    every = spark.read.option("mergeSchema", True).parquet(_files(folder, table))
    raw = every if paths is None else spark.read.schema(every.schema).parquet(*paths)
    return raw.withColumn("_source_file", F.col("_metadata.file_path"))


def scan_new_files(
    spark: SparkSession, folder: str, table: str, fresh: DataFrame
) -> DataFrame | None:
    """Scan only the files of ``fresh``, a part of :func:`list_files`; None if there are none.

    The driver takes the names of the new files, as it does for the file index of any scan.
    """
    names = [row.path for row in fresh.select("path").collect()]
    # Escaped, so that a character of a name is not read as a pattern.
    paths = [re.sub(r"([*?\[\]{}\\])", r"\\\1", name) for name in names]
    return scan_files(spark, folder, table, paths) if paths else None


def register_landing(spark: SparkSession, folder: str, database: str) -> None:
    """Enter every Parquet table found in a folder in the catalog, as a view of its files."""
    folder = folder.rstrip("/")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/*.parquet")
    name = F.regexp_extract("path", r"([^/]+)\.parquet(/[^/]*)?$", 1)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for row in listed.select(name.alias("name")).distinct().collect():
        source = f"SELECT * FROM parquet.`{folder}/{row.name}.parquet`"
        spark.sql(f"CREATE OR REPLACE VIEW {database}.`{row.name}` AS {source}")


def scan_lineage(spark: SparkSession, folder: str, tables: Sequence[str]) -> DataFrame:
    """(file_name, n_rows, n_columns) of every file the scans of the tables read."""
    name = F.element_at(F.split("_source_file", "/"), -1).alias("file_name")
    found = []
    for table in tables:
        rows = scan_files(spark, folder, table)
        counted = rows.groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"))
        found.append(counted.withColumn("n_columns", F.lit(len(rows.columns) - 1).cast("long")))
    return reduce(DataFrame.unionByName, found)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, actual_rows) of each frame, as one relation."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("actual_rows")).select(
            F.lit(name).alias("table_name"), "actual_rows"
        )
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def source_inventory(
    tables: Mapping[str, DataFrame], expected: Sequence[str] = LOAD_ORDER
) -> DataFrame:
    """Row count and status of each found or expected table: OK, EMPTY, MISSING or UNEXPECTED."""
    spark = next(iter(tables.values())).sparkSession
    wanted = spark.createDataFrame([(name,) for name in expected], "wanted string")
    joined = row_counts(tables).join(wanted, F.col("table_name") == F.col("wanted"), "full_outer")
    status = (
        F.when(F.col("table_name").isNull(), "MISSING")
        .when(F.col("wanted").isNull(), "UNEXPECTED")
        .when(F.col("actual_rows") == 0, "EMPTY")
        .otherwise("OK")
    )
    return joined.select(
        F.coalesce("table_name", "wanted").alias("table_name"),
        F.coalesce("actual_rows", F.lit(0)).alias("row_count"),
        status.alias("status"),
    )


def require_inventory(inventory: DataFrame) -> None:
    """Raise unless every table of the inventory is OK."""
    wrong = inventory.filter("status <> 'OK'").orderBy("table_name").collect()
    if wrong:
        named = ", ".join(f"{row.table_name}={row.status}" for row in wrong)
        raise ValueError(f"source inventory mismatch: {named}")


def export_tables(
    tables: Mapping[str, DataFrame], folder: str, manifest: Sequence[Mapping] = ()
) -> None:
    """Write each table as Parquet and as CSV with a header, plus a JSON manifest."""
    folder = folder.rstrip("/")
    for name, frame in tables.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        frame.write.mode("overwrite").option("header", True).csv(f"{folder}/csv/{name}")
    if manifest:
        spark = next(iter(tables.values())).sparkSession
        lines = spark.createDataFrame([(json.dumps(entry),) for entry in manifest], "value string")
        lines.coalesce(1).write.mode("overwrite").text(f"{folder}/manifest")
