"""Tables as immutable Parquet snapshots, with a small table naming the current ones."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone
from zlib import crc32

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardhouse.sources.files import drop_folder, folder_state
from wardhouse.sources.keyed import KeyedTable

STG, WRK, REJECTS, SOC, OBS, TCH = "stg", "wrk", "rej", "soc", "obs", "tch"

_LOG = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),
        # Catalog name of a bucketed snapshot, NULL for a plain one.
        T.StructField("bucketed_as", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("bucket_keys", T.ArrayType(T.StringType())),
        # Columns and types of the snapshot, as JSON.
        T.StructField("columns", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("batch_dt", T.DateType()),
        T.StructField("exec_id", T.LongType()),
        T.StructField("written_at", T.TimestampNTZType()),
        # Folder column of a snapshot whose rows are not all for every reader, and
        # the values that only read_parts shows.
        T.StructField("part", T.StringType()),
        T.StructField("hidden", T.ArrayType(T.StringType())),
    ]
)

# What is needed to open a snapshot.
_OPENING = (
    "version", "path", "bucketed_as", "buckets", "bucket_keys", "columns", "batch_dt", "part", "hidden",
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class Warehouse:
    """Where the layers live. One writer of a table at a time, any number of readers.

    A write never touches what is being read: it fills a new folder, and only
    a finished write is entered in the snapshot log.

    With ``buckets`` the snapshots written with keys are bucketed on them and
    known to the session's catalog. An upsert then reads its target in place
    and only moves the batch, and deduplication on the key needs no shuffle.
    The log keeps each snapshot's columns, keys and buckets; an application
    whose catalog does not know a table registers it over its files.
    """

    spark: SparkSession
    root: str
    buckets: int = 0
    #: Folders of a keyed table; see :meth:`keyed`.
    slots: int = 64

    def __post_init__(self) -> None:
        # Tables may be written side by side, the log takes one entry after the other.
        self._lock = threading.RLock()
        none = self.spark.createDataFrame([], _LOG)
        none.write.mode("ignore").parquet(self._log_path)
        self._seen, self._known = None, {}

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def _log_path(self) -> str:
        return self.path("_snapshots")

    def _log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(self._log_path)

    def _current(self, layer: str) -> dict:
        """Version and path of every table of a layer: one row per table name.

        The log is read again when its files have changed.
        """
        with self._lock:
            state = folder_state(self.spark, self._log_path)
            if state != self._seen:
                latest = (
                    self._log()
                    .groupBy("layer", "name")
                    .agg(F.max_by(F.struct(*_OPENING), "version").alias("s"))
                )
                self._known = {(row["layer"], row["name"]): row["s"] for row in latest.collect()}
                self._seen = state
            return {name: s for (of, name), s in self._known.items() if of == layer}

    def exists(self, layer: str, name: str) -> bool:
        return name in self._current(layer)

    def find(self, layer: str, name: str) -> DataFrame | None:
        """The current snapshot, or None if the table was never written."""
        current = self._current(layer).get(name)
        return None if current is None else self._open(current)

    def read(self, layer: str, name: str) -> DataFrame:
        """The current snapshot; ``LookupError`` if the table was never written."""
        return self.read_all(layer, [name])[name]

    def read_all(self, layer: str, names: Iterable[str]) -> dict[str, DataFrame]:
        """Current snapshots of several tables of a layer."""
        current, names = self._current(layer), list(names)
        unknown = [name for name in names if name not in current]
        if unknown:
            raise LookupError(f"no snapshot of {layer}.{unknown} under {self.root}")
        return {name: self._open(current[name]) for name in names}

    def batch_date(self, layer: str, name: str) -> date | None:
        """Batch date of the current snapshot, if it has one."""
        current = self._current(layer).get(name)
        return current["batch_dt"] if current else None

    def keyed(self, layer: str, name: str, keys: Sequence[str]) -> KeyedTable:
        """The table as one that batches rewrite in part; :meth:`enter` makes its state current."""
        path = self.path(layer, name, f"by_key_{self.slots}")
        return KeyedTable(self.spark, path, tuple(keys), self.slots)

    def read_parts(self, layer: str, name: str, values: Sequence[str]) -> DataFrame:
        """The rows of the current snapshot in the given parts; no other part is read."""
        snapshot = self._current(layer)[name]
        return self._all_parts(snapshot).filter(F.col(snapshot["part"]).isin(*values)).drop(snapshot["part"])

    def _open(self, snapshot) -> DataFrame:
        rows = self._all_parts(snapshot)
        if not snapshot["part"]:
            return rows
        shown = ~F.col(snapshot["part"]).isin(*snapshot["hidden"])
        return rows.filter(shown).drop(snapshot["part"])

    def _all_parts(self, snapshot) -> DataFrame:
        table, path = snapshot["bucketed_as"], self.path(snapshot["path"])
        schema = T.StructType.fromJson(json.loads(snapshot["columns"]))
        if not table:
            return self.spark.read.schema(schema).parquet(path)
        if not self.spark.catalog.tableExists(table):
            keys = ", ".join(f"`{k}`" for k in snapshot["bucket_keys"])
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet"
                f" CLUSTERED BY ({keys}) INTO {snapshot['buckets']} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(table)

    def _table_name(self, layer: str, name: str, version: int) -> str:
        # The root keeps warehouses in one catalog apart.
        return f"wh{crc32(self.root.encode()):08x}_{layer}_{name.lower()}_v{version:06d}"

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        batch_dt: date | None = None,
        exec_id: int | None = None,
        keys: Sequence[str] = (),
        part: str | None = None,
        hidden: Sequence[str] = (),
    ) -> int:
        """Write the next snapshot and make it current. Returns its row count.

        ``keys`` are what the table is looked up and deduplicated by. With
        ``part`` the rows are written into a folder for each of that column's few
        values; readers do not see the column, nor the rows of ``hidden`` values,
        which :meth:`read_parts` shows. Such a snapshot is not bucketed.
        """
        current = self._current(layer).get(name)
        version = (current["version"] if current else 0) + 1
        path = f"{layer}/{name}/v{version:06d}"
        seen = Observation()
        observed = df.observe(seen, F.count("*").alias("n"))
        bucketed = self.buckets and keys and not part
        table = self._table_name(layer, name, version) if bucketed else None
        # A leftover of a failed attempt at this version is replaced.
        writer = observed.write.mode("overwrite")
        if table:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            writer.bucketBy(self.buckets, *keys).option("path", self.path(path)).saveAsTable(table)
        else:
            (writer.partitionBy(part) if part else writer).parquet(self.path(path))
        n_rows = seen.get["n"]
        layout = (table, self.buckets, list(keys)) if table else (None, None, None)
        self._log_entry(
            layer, name, version, path, *layout, df.schema.json(), n_rows, batch_dt, exec_id, utc_now(),
            part, list(hidden) if part else None,
        )
        return n_rows

    def enter(
        self, layer: str, name: str, table: KeyedTable, batch_dt: date | None, exec_id: int | None
    ) -> None:
        """Make the present state of a keyed table the current one. Its rows are not counted."""
        current = self._current(layer).get(name)
        version = (current["version"] if current else 0) + 1
        path = table.path.removeprefix(self.path(""))
        self._log_entry(
            layer, name, version, path, None, None, None, table.rows().schema.json(), None, batch_dt,
            exec_id, utc_now(), None, None,
        )

    def _log_entry(self, *entry) -> None:
        row = self.spark.createDataFrame([entry], _LOG).coalesce(1)
        with self._lock:
            row.write.mode("append").parquet(self._log_path)

    def drop_old(self, layer: str, name: str, keep: int = 2) -> list[str]:
        """Delete all but the newest snapshots of a table. A keyed table has one folder for all."""
        wanted = (F.col("layer") == layer) & (F.col("name") == name)
        newest = self._log().filter(wanted).orderBy(F.desc("version"))
        kept = {r["path"] for r in newest.select("path").limit(keep).collect()}
        old = [r for r in newest.select("path", "bucketed_as").offset(keep).collect() if r["path"] not in kept]
        for row in old:
            if row["bucketed_as"]:
                self.spark.sql(f"DROP TABLE IF EXISTS {row['bucketed_as']}")
            drop_folder(self.spark, self.path(row["path"]))
        return [self.path(row["path"]) for row in old]
