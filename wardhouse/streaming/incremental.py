"""Batches picked up as their files arrive."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardhouse.contracts import Table
from wardhouse.plans.daily import ingest_contract
from wardhouse.sources.batch_files import batch_date_of, batch_glob
from wardhouse.sources.warehouse import Warehouse

# What the file source says of a file; only the path is read.
_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def follow(wh: Warehouse, inputs: str, contract: Table, checkpoint: str) -> StreamingQuery:
    """Load every day of one table that has new files, oldest day first, then stop.

    The stream only learns which files are new; it does not open them. A day
    with a new file is loaded as a batch is, from all its files, so that shards
    that come later, records over several lines, another column order and a
    broken contract are met as there. A replayed micro-batch gives the same
    table: a reload replaces, an upsert of the same rows changes nothing.
    """
    arriving = (
        wh.spark.readStream.format("binaryFile")
        .schema(_FILE)
        .load(batch_glob(inputs, contract.name))
        .select(batch_date_of(F.col("path")).alias("_batch_dt"))
    )

    def load(files: DataFrame, _: int) -> None:
        for day in batch_days(files):
            ingest_contract(wh, inputs, day, contract)

    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_days(files: DataFrame) -> list[date]:
    """Batch dates in a micro-batch, oldest first: one value per day of files."""
    return [r["_batch_dt"] for r in files.select("_batch_dt").distinct().orderBy("_batch_dt").collect()]
