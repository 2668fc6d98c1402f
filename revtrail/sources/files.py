"""Reading and writing table files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from revtrail.sources.schemas import schema_of, typed


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A table from parquet, ORC or CSV with its declared types.

    CSV is read as text and then given its types, so that true, True and 1 mean the same.
    """
    schema = schema_of(table)
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    reader = spark.read.schema(text).option("header", True).option("mode", "FAILFAST")
    return typed(reader.csv(path), table)


def load_tables(
    spark: SparkSession,
    folder: str,
    tables: Iterable[str] = ("leads", "opportunities", "closed_deals"),
    fmt: str = "csv",
    pattern: str = "{table}.{fmt}",
) -> dict[str, DataFrame]:
    """Named tables of one folder, registered as views under their names."""
    loaded = {}
    for table in tables:
        path = f"{folder}/{pattern.format(table=table, fmt=fmt)}"
        loaded[table] = read_table(spark, path, table, fmt)
        loaded[table].createOrReplaceTempView(table)
    return loaded


def write_table(
    rows: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
) -> None:
    """Replace a table's files; facts are best partitioned by a coarse date column."""
    writer = rows.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_bucketed(rows: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Replace a catalog table bucketed by its join key.

    Leads and opportunities saved with the same number of buckets on `lead_id` join
    without a shuffle in every later query.
    """
    (
        rows.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return rows.sparkSession.table(table)


def write_outputs(
    tables: dict[str, DataFrame], folder: str, fmt: str = "parquet"
) -> dict[str, StructType]:
    """Write tables under their names; the answer are the types `read_back` needs for CSV."""
    for name, rows in tables.items():
        write_table(rows, f"{folder}/{name}", fmt)
    return {name: rows.schema for name, rows in tables.items()}


def read_back(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """A table as `write_table` wrote it; parquet and ORC keep their types, CSV needs `schema`."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError(f"{path}: CSV keeps no types, so the schema must be given")
        reader = reader.schema(schema).option("header", True).option("mode", "FAILFAST")
    return reader.load(path)
