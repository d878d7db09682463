"""CSV, JSON and Parquet scans, incremental filter and marks, bronze columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def csv_scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None, delimiter: str = ",", encoding: str = "UTF-8", warehouse: bool = False) -> DataFrame:
    """All values as strings; a file, folder or glob. ``warehouse``: values may be enclosed in quotes and hold line ends, blanks
    are trimmed, empty, NULL and null are null, and a row with too few values is filled, one with too many cut."""
    reader = spark.read.option("header", True).option("sep", delimiter).option("encoding", encoding).option("mode", "PERMISSIVE")
    if warehouse:
        reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    df = reader.csv(path)
    if warehouse:
        return df.select(*[F.when(~F.col(c).isin("", "NULL", "null"), F.col(c)).alias(c) for c in df.columns])
    return df


def json_scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON objects, or an outer array of them."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def parquet_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_scan(df: DataFrame, where: str | None = None, limit: int | None = None) -> DataFrame:
    """The rows of a table that meet a condition, at most ``limit`` of them, which must be positive."""
    out = df.where(where) if where else df
    if limit is None:
        return out
    if limit <= 0:
        raise ValueError("limit must be positive")
    return out.limit(limit)


def newer_than(mark_column: str, since: str | None) -> Column:
    """True for rows to load: no mark yet, no value, or a text after the mark. An empty text is a value."""
    if since is None:
        return F.lit(True)
    value = F.col(mark_column).cast("string")
    return value.isNull() | (value > F.lit(since))


def mark_of(df: DataFrame, mark_column: str) -> Column:
    """Aggregate: the greatest non-empty text of the column."""
    return F.max(F.nullif(F.col(mark_column).cast("string"), F.lit("")))


def bronze(df: DataFrame, source_system: str, source_object: str, key: Sequence[str], run_id: str, loaded_at: Column) -> DataFrame:
    """Adds the audit columns that the rows lack; raw_payload keeps the original row, nulls included."""
    payload = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    added = {
        "source_record_id": F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in key]),
        "source_system": F.lit(source_system), "source_object": F.lit(source_object), "load_batch_id": F.lit(run_id), "load_timestamp": loaded_at, "raw_payload": payload,
    }
    return df.withColumns({k: v for k, v in added.items() if k not in df.columns})
