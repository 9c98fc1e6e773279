"""Keyed tables of which a batch rewrites only what it touches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardhouse.operators.dedup import any_null
from wardhouse.session import shuffles_dropped
from wardhouse.sources.files import child_folders, drop_folder, folder_bytes, has_file, move_files

SLOT = "_slot"
#: The slot of rows without a whole key.
LOOSE = -1
#: Bytes for each core up to which a merge is one step, and the steps of a larger one at most.
AT_ONCE, STEPS = 32 << 20, 8


@dataclass
class KeyedTable:
    """Parquet partitioned by a hash of the key into ``slots`` folders.

    A batch can only change rows of its own keys, so only the folders of their
    slots are read and written. Their next content is written beside the table
    first; the files of a finished one are moved into the folders, and if that is
    cut short, it is done again from there before the table is used. One writer at a time; readers
    open the table after a write.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    slots: int = 64

    @property
    def _pending(self) -> str:
        return f"{self.path}_pending"

    def slot(self) -> Column:
        hashed = F.pmod(F.xxhash64(*self.keys), F.lit(self.slots)).cast("int")
        return F.when(any_null(self.keys), F.lit(LOOSE)).otherwise(hashed)

    def exists(self) -> bool:
        return any(f.startswith(f"{SLOT}=") for f in child_folders(self.spark, self.path))

    def rows(self) -> DataFrame:
        self.recover()
        return self.spark.read.parquet(self.path)

    def _batch_rows(self, batch: DataFrame) -> dict[int, int]:
        """Rows of a batch in each of its slots, and no rows in that of rows without a key if the
        table has it: at most one number for each slot."""
        with shuffles_dropped(self.spark):
            found = {r[0]: r[1] for r in batch.groupBy(self.slot().alias(SLOT)).count().collect()}
        if f"{SLOT}={LOOSE}" in child_folders(self.spark, self.path):
            found.setdefault(LOOSE, 0)
        return dict(sorted(found.items()))

    def touched(self, batch: DataFrame) -> list[int]:
        """The slots of a batch, and that of rows without a key if the table has it: at most
        one number for each slot."""
        return list(self._batch_rows(batch))

    def _steps(self, batch: DataFrame, rows: dict[int, int]) -> list[list[int]]:
        """The slots of a batch that are merged together: all, or some after others if that is much."""
        n_bytes = sum(rows.values()) * batch._jdf.schema().defaultSize() + sum(
            folder_bytes(self.spark, f"{self.path}/{SLOT}={slot}") for slot in rows
        )
        if n_bytes <= AT_ONCE * self.spark.sparkContext.defaultParallelism:
            return [list(rows)]
        keyed = [slot for slot in rows if slot != LOOSE]
        loose = [[LOOSE]] if LOOSE in rows else []
        return loose + [keyed[n::STEPS] for n in range(min(STEPS, len(keyed)))]

    def merge(
        self, batch: DataFrame, empty: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]
    ) -> list[int]:
        """Replace the rows of the touched slots by ``merged(rows, batch)``; the slots.

        ``empty`` has the table's columns, for the first batch. Rows must stay in
        their slot, that is, keep their key. A large merge calls ``merged`` for some slots
        after others, with the rows of those slots only, so that what it shuffles is on
        disk in parts; all are published at its end.
        """
        self.recover()
        rows = self._batch_rows(batch)
        steps = self._steps(batch, rows)
        exists = self.exists()
        for n, slots in enumerate(steps):
            held, some = empty, batch
            if exists:
                held = self.spark.read.parquet(self.path).filter(F.col(SLOT).isin(slots)).drop(SLOT)
            if len(steps) > 1:
                some = batch.filter(self.slot().isin(slots))
            after = merged(held, some).withColumn(SLOT, self.slot())
            # Large slots are split over tasks, small ones share a task. The tasks of a join have the
            # right size for one slot already.
            if len(steps) == 1 or slots == [LOOSE] or len(slots) > 1:
                after = after.hint("rebalance", F.col(SLOT))
            last = n == len(steps) - 1
            # The mark of a finished write comes with the last step.
            options = {"compression": "zstd", "mapreduce.fileoutputcommitter.marksuccessfuljobs": last}
            write = after.write.mode("append" if n else "overwrite").options(**options)
            with shuffles_dropped(self.spark):
                write.partitionBy(SLOT).parquet(self._pending)
        kept = set(child_folders(self.spark, self._pending))
        self._publish()
        for slot in rows:
            if f"{SLOT}={slot}" not in kept:
                drop_folder(self.spark, f"{self.path}/{SLOT}={slot}")
        return list(rows)

    def recover(self) -> None:
        """Finish a write that was cut short while folders were replaced."""
        folders = child_folders(self.spark, self._pending)
        if not folders:
            return
        if has_file(self.spark, f"{self._pending}/_SUCCESS"):
            self._publish()
        else:
            drop_folder(self.spark, self._pending)

    def _publish(self) -> None:
        for slot in child_folders(self.spark, self._pending):
            move_files(self.spark, f"{self._pending}/{slot}", f"{self.path}/{slot}")
        drop_folder(self.spark, self._pending)
