"""Dense surrogate keys 1..n in a global order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardhouse.operators.dedup import total_order
from wardhouse.session import work_path

# monotonically_increasing_id() keeps the row's position in the low 33 bits.
_POSITION_BITS = 33


def dense_key(
    df: DataFrame, order_by: Sequence[str], name: str, partitions: int | None = None
) -> DataFrame:
    """Number rows 1..n as ``ROW_NUMBER() OVER (ORDER BY order_by)`` would.

    Rows are range-partitioned on the order and sorted inside each partition; a
    row's number is its position plus the rows of all earlier partitions. The
    placed rows are written to a work table in the shared folder before they are
    counted, since a second run of the range partitioning may choose other
    bounds. Only the counts, one row per partition, are summed in a single
    window.

    The order should be unique, as business keys are; equal rows are spread by
    nothing and share a partition.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = total_order(df, [f"{c} ASC NULLS LAST" for c in order_by])
    path = work_path(spark, name)
    (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .select(
            *df.columns,
            F.shiftright("_at", _POSITION_BITS).cast("int").alias("_part"),
            F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
        )
        .write.parquet(path)
    )
    placed = spark.read.parquet(path)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    # One row per partition of `placed`: small by construction.
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_pos") + 1).cast("bigint").alias(name)
    )
