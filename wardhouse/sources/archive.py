"""Every batch as received, one partition per batch date."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardhouse.sources.files import child_folders, drop_folder


def archived(df: DataFrame, batch_dt: date | Column, load_dttm: datetime, exec_id: int) -> DataFrame:
    """The rows as they are, plus batch date, load time and execution."""
    day = batch_dt if isinstance(batch_dt, Column) else F.lit(batch_dt)
    return df.withColumns(
        {
            "batch_dt": day.cast("date"),
            "load_dttm": F.lit(load_dttm).cast("timestamp_ntz"),
            "exec_id": F.lit(exec_id).cast("bigint"),
        }
    )


def write_archive(df: DataFrame, path: str) -> None:
    """Add archived rows; a batch that is already there is replaced, others stay."""
    (
        df.write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", compression="zstd")
        .partitionBy("batch_dt")
        .parquet(path)
    )


def replay(spark: SparkSession, path: str, batch_dt: date) -> DataFrame:
    """The rows of one past batch, without the audit columns; reads one partition."""
    return (
        spark.read.parquet(path)
        .filter(F.col("batch_dt") == F.lit(batch_dt))
        .drop("batch_dt", "load_dttm", "exec_id")
    )


def retained(df: DataFrame, as_of: date, months: int) -> DataFrame:
    """Rows whose batch is not older than the retention."""
    return df.filter(F.col("batch_dt") >= F.add_months(F.lit(as_of), -months))


def purge(spark: SparkSession, path: str, as_of: date, months: int) -> list[date]:
    """Delete the partitions past retention; kept partitions are not rewritten."""
    oldest = spark.range(1).select(F.add_months(F.lit(as_of), -months).alias("d")).first()["d"]
    prefix = "batch_dt="
    expired = []
    for folder in child_folders(spark, path):
        if folder.startswith(prefix) and date.fromisoformat(folder[len(prefix):]) < oldest:
            drop_folder(spark, f"{path.rstrip('/')}/{folder}")
            expired.append(date.fromisoformat(folder[len(prefix):]))
    return expired
