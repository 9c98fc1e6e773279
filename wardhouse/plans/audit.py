"""Run tracking: events are appended, the current state is the latest event."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardhouse.operators.joins import join_dimension
from wardhouse.session import work_path
from wardhouse.sources.files import child_files, child_folders
from wardhouse.sources.warehouse import utc_now

# Statuses and run types.
RUNNING, DONE, FAILED = "ENC", "OK", "KO"
RUN_TYPES = ("INSTALL", "DAILY", "MANUAL")

EVENTS = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        # NULL for an event of the run itself.
        T.StructField("exec_id", T.LongType()),
        T.StructField("scrpt_name", T.StringType()),
        T.StructField("run_typ", T.StringType()),
        T.StructField("batch_dt", T.DateType()),
        T.StructField("stts_cd", T.StringType()),
        T.StructField("err_msg", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
    ]
)


# Folder of an event.
_DAY = "at_day"


def _by_day(events: DataFrame) -> DataFrame:
    return events.withColumn(_DAY, F.to_date("at"))


def _latest(name: str):
    """Value of the closing event, or of the opening one while it runs."""
    rank = F.struct(F.when(F.col("stts_cd") == RUNNING, 0).otherwise(1), F.col("at"))
    return F.max_by(name, rank)


def run_state(events: DataFrame) -> DataFrame:
    """One row per run: start, end, status, type, batch."""
    runs = events.filter(F.col("exec_id").isNull())
    return runs.groupBy("run_id").agg(
        F.min("at").alias("run_strt_dttm"),
        F.max(F.when(F.col("stts_cd") != RUNNING, F.col("at"))).alias("run_end_dttm"),
        _latest("stts_cd").alias("run_stts_cd"),
        F.max("run_typ").alias("run_typ"),
        F.max("batch_dt").alias("batch_dt"),
    )


def step_state(events: DataFrame) -> DataFrame:
    """One row per step: run, name, start, end, status, error."""
    steps = events.filter(F.col("exec_id").isNotNull())
    return steps.groupBy("exec_id").agg(
        F.max("run_id").alias("run_id"),
        F.max("scrpt_name").alias("scrpt_name"),
        F.min("at").alias("exec_strt_dttm"),
        F.max(F.when(F.col("stts_cd") != RUNNING, F.col("at"))).alias("exec_end_dttm"),
        _latest("stts_cd").alias("exec_stts_cd"),
        _latest("err_msg").alias("err_msg"),
    )


def lineage(rows: DataFrame, steps: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows with the step that wrote them and the run it belongs to.

    Steps and runs are joined first. Most rows of a table carry the few
    execution ids of its last loads, so those ids are hot.
    """
    known = steps.select("exec_id", "run_id", "scrpt_name", "exec_strt_dttm").join(
        runs.select("run_id", "run_strt_dttm", "run_stts_cd"), "run_id"
    )
    return join_dimension(rows, known, ["exec_id"])


@dataclass
class RunLog:
    """Appends run and step events to one Parquet table, a folder a day. Ids come from the caller."""

    spark: SparkSession
    path: str

    def _append(self, **event) -> None:
        row = tuple(event.get(f.name) for f in EVENTS.fields)
        dated = _by_day(self.spark.createDataFrame([row], EVENTS)).coalesce(1)
        dated.write.mode("append").partitionBy(_DAY).parquet(self.path)

    def events(self) -> DataFrame:
        none = _by_day(self.spark.createDataFrame([], EVENTS))
        none.write.mode("ignore").partitionBy(_DAY).parquet(self.path)
        return self.spark.read.schema(none.schema).parquet(self.path).drop(_DAY)

    def compact(self, before: date) -> list[date]:
        """Merge the events of each earlier day into one file; the days that were merged.

        Days of one file are left alone. The merged events are written beside the log
        first, and replace their days' folders only.
        """
        folders = child_folders(self.spark, self.path)
        days = [date.fromisoformat(f.removeprefix(f"{_DAY}=")) for f in folders if f.startswith(f"{_DAY}=")]
        days = [
            d for d in days
            if d < before and len(child_files(self.spark, f"{self.path}/{_DAY}={d}", ".parquet")) > 1
        ]
        if not days:
            return []
        merged = work_path(self.spark, "events")
        of_days = _by_day(self.events()).filter(F.col(_DAY).isin(*days))
        of_days.repartition(_DAY).write.partitionBy(_DAY).parquet(merged)
        (
            self.spark.read.schema(of_days.schema).parquet(merged).repartition(_DAY)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(_DAY).parquet(self.path)
        )
        return sorted(days)

    def open_run(
        self, run_id: int, run_typ: str, batch_dt: date | None = None, at: datetime | None = None
    ) -> None:
        if run_typ not in RUN_TYPES:
            raise ValueError(f"unknown run type {run_typ!r}; known types: {list(RUN_TYPES)}")
        self._append(run_id=run_id, run_typ=run_typ, batch_dt=batch_dt, stts_cd=RUNNING,
                     at=at or utc_now())

    def close_run(self, run_id: int, ok: bool, at: datetime | None = None) -> None:
        self._append(run_id=run_id, stts_cd=DONE if ok else FAILED, at=at or utc_now())

    @contextmanager
    def run(self, run_id: int, run_typ: str, batch_dt: date | None = None) -> Iterator[None]:
        """A run that closes OK, or KO when its body raises."""
        self.open_run(run_id, run_typ, batch_dt)
        try:
            yield
        except BaseException:
            self.close_run(run_id, ok=False)
            raise
        self.close_run(run_id, ok=True)

    @contextmanager
    def step(self, run_id: int, exec_id: int, name: str) -> Iterator[None]:
        """A step that closes OK, or KO with the error's text when its body raises."""
        self._append(run_id=run_id, exec_id=exec_id, scrpt_name=name, stts_cd=RUNNING,
                     at=utc_now())
        try:
            yield
        except BaseException as error:
            self._append(run_id=run_id, exec_id=exec_id, scrpt_name=name, stts_cd=FAILED,
                         err_msg=str(error), at=utc_now())
            raise
        self._append(run_id=run_id, exec_id=exec_id, scrpt_name=name, stts_cd=DONE, at=utc_now())
