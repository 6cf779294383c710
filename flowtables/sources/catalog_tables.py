"""Metastore tables (S2) and JDBC tables (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def metastore_table_io(spark: SparkSession, table: str) -> DataFrame:
    """Read a table registered in the session catalog."""
    return spark.table(table)


def write_metastore_table(df: DataFrame, table: str, mode: str = "overwrite", insert: bool = False, path: str | None = None) -> None:
    """Store as a catalog table (``insertInto`` appends/overwrites an
    existing table by position); ``path`` makes it an external one."""
    if insert:
        df.write.insertInto(table, overwrite=(mode == "overwrite"))
    else:
        writer = df.write.mode(mode)
        (writer.option("path", path) if path else writer).saveAsTable(table)


def jdbc_table_io(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """S3: read a JDBC table; with a numeric ``column`` and bounds the read is
    split into ``num_partitions`` range queries run by parallel tasks."""
    props = dict(properties or {})
    if column is not None:
        return spark.read.jdbc(
            url,
            table,
            column=column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions,
            properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)


def write_jdbc_table(df: DataFrame, url: str, table: str, mode: str = "overwrite", properties: dict[str, str] | None = None) -> None:
    """S3: store through JDBC (one connection per task)."""
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))
