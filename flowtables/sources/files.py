"""File-backed datasets (S1) and CSV datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def file_table_io(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read a file dataset; filters and projections applied later reach
    the scan (Parquet/ORC push-down, column pruning)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_file_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    **options: str,
) -> None:
    """Store a file dataset.  With ``partition_by`` and
    ``partitionOverwriteMode=dynamic`` an overwrite replaces only the
    partitions present in ``df``."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


#: How a null is written in CSV, to tell it from an empty text (which is written as two quotes).
CSV_NULL = "\\N"
_CSV = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def csv_table_io(spark: SparkSession, path: str, schema: StructType | str, null: str = CSV_NULL) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass).
    Fields may hold quotes, separators and line breaks."""
    return spark.read.schema(schema).options(**_CSV, multiLine="true", nullValue=null, emptyValue="").csv(path)


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite", null: str = CSV_NULL) -> None:
    """CSV with a header; timestamps written in ISO form, nulls as
    ``null`` (a text that equals it is read back as null)."""
    (
        df.write.mode(mode)
        .options(**_CSV, nullValue=null, emptyValue='""')
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )
