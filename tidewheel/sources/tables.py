"""Reading and writing tables."""

from __future__ import annotations

import os
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators.selection import first_k


def table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session's catalog."""
    return spark.read.table(name)


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Result of a SQL text; ``{name}`` in it stands for the DataFrame passed as ``name``."""
    return spark.sql(sql, **tables)


def limited(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest integer ``key``.

    The cut-off is found first, so the read itself is one filter that reaches
    the files and skips row groups.
    """
    return df.where(first_k(df, F.col(key), n))


def as_of_version(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    at: int | str | date,
    order: Sequence[str] = (),
) -> DataFrame:
    """The table as it stood at version ``at``: the latest row per key up to it.

    ``order`` settles rows of one key that share a version.
    """
    latest = F.max_by(F.struct(*df.columns), F.struct(version, *order))
    rows = df.where(F.col(version) <= F.lit(at)).groupBy(*keys).agg(latest.alias("__row"))
    return rows.select("__row.*")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    rows_per_file: int = 5_000_000,
) -> None:
    """Write parquet; the row bound keeps a hot partition value in many files."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "errorifexists") -> None:
    """Write a table of the session's catalog."""
    df.write.mode(mode).saveAsTable(name)


def summary(df: DataFrame) -> DataFrame:
    """Per column: type, row count, nulls, smallest and largest value, in one pass."""
    kinds = dict(df.dtypes)
    measures = []
    for name in df.columns:
        # Adding zero turns the equal value -0.0 into 0.0.
        value = F.col(name) + F.lit(0.0) if kinds[name] in ("double", "float") else F.col(name)
        measures += [
            F.count(name).alias(f"present_{name}"),
            F.min(value).cast("string").alias(f"min_{name}"),
            F.max(value).cast("string").alias(f"max_{name}"),
        ]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *measures)
    entries = [_summary_entry(name, kinds[name]) for name in df.columns]
    return row.select(F.inline(F.array(*entries)))


def _summary_entry(name: str, kind: str) -> Column:
    return F.struct(
        F.lit(name).alias("column_name"),
        F.lit(kind).alias("column_type"),
        F.col("rows").alias("n_rows"),
        (F.col("rows") - F.col(f"present_{name}")).alias("n_nulls"),
        F.col(f"min_{name}").alias("min_value"),
        F.col(f"max_{name}").alias("max_value"),
    )


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows written down in the program."""
    return spark.createDataFrame(list(rows), schema)


def labelled_features(df: DataFrame, features: str, label: str) -> DataFrame:
    """``features`` as ``array<double>`` and ``label`` as int."""
    return df.withColumns(
        {features: F.col(features).cast("array<double>"), label: F.col(label).cast("int")}
    )
