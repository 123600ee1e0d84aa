"""The parquet test tables, read with explicit column lists (pruned scans)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
               spread: bool = False) -> DataFrame:
    """Read a table with the given columns only.

    ``spread``: for CPU-heavy row work right after the scan (tokenizing).
    When the scan yields fewer splits than the cluster has cores (a small file
    with one row group), rows are dealt round-robin to all cores. On a large
    input the scan already has many splits and nothing is added.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    if spread:
        df = spread_rows(df)
    return df


def spread_rows(df: DataFrame) -> DataFrame:
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a file stream (one table out of a folder of tables)."""
    schema = spark.read.parquet(table_path(sf_dir, name)).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(sf_dir)
