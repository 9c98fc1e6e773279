"""Product codes of vectors: every part of a vector becomes its nearest codebook entry's index.

Vectors become integers, floor(scale * x), and are cut into equal consecutive
parts. The nearest entry of a part is found by its grid cell: the part's coarse
cell is hashed and looked up in a task's memo, which holds the entries that some
point of the cell's box may be nearest to. An entry is left out where its least
distance to the box is above another's greatest. Only the rest are evaluated
exactly, so the memo never changes a result, only the work.

Codebooks and the sums that move them (entries x dimensions numbers) are all that
goes through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import written
from wardhouse.operators.joins import join_dimension

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Cells that the box around a part's codebook is cut into, about.
CELLS = 4096
#: Cells of a part that a task remembers; a full memo is emptied and fills anew.
KEPT_CELLS = 20_000
#: Numbers handled at once inside a task.
CHUNK = 1_000_000
#: Up to so many groups their totals are broadcast; more are joined by shuffle.
FEW_GROUPS = 100_000


class CellMemo:
    """The nearest entry of points of one part, by the cells of a grid."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count, size = entries.shape
        spread = int((entries.max(0) - entries.min(0)).max()) if size else 0
        steps = max(1, int(CELLS ** (1 / max(size, 1)) + 1e-9))
        self.width = max(1, -(-spread // steps))
        self.mix = np.cumprod(np.full(size, 0x9E3779B97F4A7C15, np.uint64))
        self._empty()

    def _empty(self) -> None:
        count, size = self.entries.shape
        self.slots: dict[int, int] = {}
        self.cells = np.empty((0, size), np.int64)
        self.near = np.empty((0, count), np.int16)
        self.many = np.empty(0, np.int16)

    def candidates(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each cell the entries that may be nearest to a point of it, ascending and padded
        with the last of them, and how many they are."""
        count, size = self.entries.shape
        near = np.empty((len(cells), count), np.int16)
        many = np.empty(len(cells), np.int16)
        step = max(1, CHUNK // max(1, count * size))
        for at in range(0, len(cells), step):
            low = (cells[at : at + step] * self.width)[:, None, :]
            high = low + (self.width - 1)
            below, above = low - self.entries, self.entries - high
            least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(2)
            most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(2)
            kept = least <= most.min(1, keepdims=True)
            number = kept.sum(1)
            # Kept entries first, in ascending order.
            order = np.argsort(~kept, axis=1, kind="stable")
            column = np.minimum(np.arange(count), number[:, None] - 1)
            near[at : at + step] = np.take_along_axis(order, column, 1)
            many[at : at + step] = number
        return near, many

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower at a tie) and the squared distance, of each point."""
        cells = points // self.width
        codes = (cells.astype(np.uint64) * self.mix).sum(1, dtype=np.uint64)
        found, first, back = np.unique(codes, return_index=True, return_inverse=True)
        if len(self.slots) + len(found) > KEPT_CELLS:
            self._empty()
        slots = np.fromiter((self.slots.get(c, -1) for c in found.tolist()), np.int64, len(found))
        new = np.flatnonzero(slots < 0)
        if len(new):
            fresh = cells[first[new]]
            near, many = self.candidates(fresh)
            slots[new] = len(self.cells) + np.arange(len(new))
            self.slots.update(zip(found[new].tolist(), slots[new].tolist(), strict=True))
            self.cells = np.concatenate([self.cells, fresh])
            self.near = np.concatenate([self.near, near])
            self.many = np.concatenate([self.many, many])
        slot = slots[back.reshape(-1)]
        many = self.many[slot].astype(np.int64)
        # Another cell with the same hash: every entry is evaluated.
        many[(self.cells[slot] != cells).any(1)] = 0
        index = np.zeros(len(points), np.int64)
        error = np.zeros(len(points), np.int64)
        every = np.arange(len(self.entries))
        width = 1
        while True:
            rows = np.flatnonzero((many > width // 2) & (many <= width) if width else many == 0)
            wide = min(width, len(every)) or len(every)
            step = max(1, CHUNK // max(1, wide * points.shape[1]))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                choice = self.near[slot[part], :wide] if width else np.tile(every, (len(part), 1))
                gap = points[part][:, None, :] - self.entries[choice]
                far = np.einsum("ned,ned->ne", gap, gap)
                best = far.argmin(1)
                index[part] = choice[np.arange(len(part)), best]
                error[part] = far[np.arange(len(part)), best]
            if not width:
                return index, error
            width = 0 if width >= len(every) else 2 * width


@dataclass
class Codebooks:
    """``entries`` is (parts, entries, numbers of a part); ``size`` the vectors' padded length."""

    entries: np.ndarray
    scale: int

    @property
    def size(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        text = ",".join(map(str, self.entries.ravel().tolist()))
        return hashlib.sha256(text.encode()).hexdigest()

    def decode(self, code: str) -> np.ndarray:
        """The vector a code stands for: its entries one after another, over the scale."""
        index = np.frombuffer(bytes.fromhex(code), np.uint8)
        return self.entries[np.arange(len(index)), index].ravel() / self.scale

    def memos(self) -> list[CellMemo]:
        return [CellMemo(part) for part in self.entries]


def finite(df: DataFrame, vector_col: str) -> DataFrame:
    """The rows whose vector and all of its components are there and finite."""
    good = F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return df.where(F.col(vector_col).isNotNull() & good)


def whole_numbers(column: pa.Array, size: int, scale: int) -> np.ndarray:
    """The vectors of a list column as rows of integers, short ones padded with zeros."""
    values = np.floor(scale * np.asarray(column.flatten(), np.float64))
    if len(values) and np.abs(values).max() > math.isqrt(2**60 // max(size, 1)):
        raise ValueError("a component's square is too large for a 64-bit error")
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    if (lengths == size).all():
        return values.astype(np.int64).reshape(len(column), size)
    out = np.zeros((len(column), size), np.int64)
    out[np.arange(size) < lengths[:, None]] = values
    return out


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    step = max(1, min(KEPT_CELLS // 2, 4 * CHUNK // max(size, 1)))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def fit(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Codebooks | None:
    """Codebooks for the vectors: none where no vector is whole.

    They start as the parts of the vectors of the smallest ids (a null id last,
    equal ids by their components), at most ``entries`` (256 or fewer) of them.
    Each round assigns all parts of all vectors and moves every used entry to
    the floor of its parts' mean. Vectors null or holding a null or non-finite
    component are left out. A vector shorter than the longest, or all where their
    length is no multiple of ``parts``, count as padded with zeros at the end.
    """
    kept = finite(
        vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")), "v"
    )
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    size = parts * -(-longest // parts)
    start = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    first = whole_numbers(pa.array([r.v for r in start], pa.list_(pa.float64())), size, scale)
    books = Codebooks(first.reshape(len(first), parts, size // parts).transpose(1, 0, 2).copy(), scale)
    for _ in range(rounds):
        books = _moved(kept, books)
    return books


def _moved(kept: DataFrame, books: Codebooks) -> Codebooks:
    parts, count, wide = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = books.memos()
        total = np.zeros((parts, count, wide), np.int64)
        number = np.zeros((parts, count), np.int64)
        for batch in _pieces(batches, books.size):
            rows = whole_numbers(batch.column(0), books.size, books.scale)
            rows = rows.reshape(batch.num_rows, parts, wide)
            for part, memo in enumerate(memos):
                index, _ = memo.nearest(rows[:, part])
                np.add.at(total[part], index, rows[:, part])
                number[part] += np.bincount(index, minlength=count)
        at = np.flatnonzero(number.ravel())
        place = (at[:, None] * wide + np.arange(wide)).ravel()
        yield pa.RecordBatch.from_pydict(
            {"place": place, "n": np.repeat(number.ravel()[at], wide), "total": total.ravel()[place]}
        )

    moved = (
        kept.select("v")
        .mapInArrow(sums, "place long, n long, total long")
        .groupBy("place")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    entries = books.entries.copy()
    flat = entries.reshape(-1)
    for place, n, total in moved.collect():
        flat[place] = total // n
    return Codebooks(entries, books.scale)


def encode(
    vectors: DataFrame,
    books: Codebooks,
    keep: tuple[str, ...] = (),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, kept columns, code, error) of every whole vector.

    ``code`` has two hex digits for each part, ``error`` is the squared distance
    to the vector the code stands for, in integer components. A kept column named
    code or error is left out. A vector longer than the codebooks raises an error.
    """
    keep = tuple(c for c in keep if c.lower() not in ("code", "error", id_col.lower()))
    rows = finite(
        vectors.select(id_col, *keep, F.col(vector_col).cast("array<double>").alias("__v")), "__v"
    )
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    parts, _, wide = books.entries.shape
    digits = np.array([f"{k:02x}" for k in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = books.memos()
        for batch in _pieces(batches, books.size):
            rows = whole_numbers(batch.columns[-1], books.size, books.scale)
            rows = rows.reshape(batch.num_rows, parts, wide)
            error = np.zeros(len(rows), np.int64)
            code = np.empty((len(rows), parts), np.int64)
            for part, memo in enumerate(memos):
                code[:, part], far = memo.nearest(rows[:, part])
                error += far
            text = ["".join(r) for r in digits[code].tolist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(text, pa.string()), pa.array(error)],
                [*batch.schema.names[:-1], "code", "error"],
            )

    return rows.mapInArrow(run, ", ".join([*kinds, "code string", "error long"]))


def with_group_error(coded: DataFrame, group_col: str, id_col: str = "vec_id") -> DataFrame:
    """Append ``<group>_error``, the error summed over all rows of one group; nulls are one group.

    ``coded`` is read twice, so it should be a written table. Totals are summed
    before the shuffle and joined back by broadcast while they are few; beyond
    that a hot group's rows are dealt out by their id.
    """
    name = f"{group_col}_error"
    keyed = coded.withColumn("__null", F.col(group_col).isNull()).withColumn(
        "__group", F.coalesce(F.col(group_col).cast("string"), F.lit(""))
    )
    keys = ["__null", "__group"]
    totals = written(keyed.groupBy(*keys).agg(F.sum("error").alias(name)), "group-errors")
    if totals.count() <= FEW_GROUPS:
        joined = keyed.join(F.broadcast(totals), keys)
    else:
        joined = join_dimension(keyed, totals, keys, spread_by=[id_col, "code"])
    return joined.drop(*keys)


def vector_codes(vectors: DataFrame, label_col: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every whole vector.

    Vectors null or holding a null or non-finite component have no row; repeated
    rows have one each; an empty table gives none. Null ids and labels are kept.
    Other columns of the input are not read.
    """
    books = fit(vectors)
    spark = vectors.sparkSession
    if books is None:
        label = vectors.schema[label_col].dataType.simpleString()
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame(
            [],
            f"vec_id {kind}, {label_col} {label}, code string, error long,"
            f" {label_col}_error long, codebooks_sha256 string",
        )
    coded = written(encode(vectors, books, keep=(label_col,)), "codes")
    return with_group_error(coded, label_col).withColumn("codebooks_sha256", F.lit(books.digest()))
