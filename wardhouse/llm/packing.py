"""Packing token sequences by cutting-stock column generation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardhouse.llm.common import give_back_memory, slices, without, written
from wardhouse.llm.token_ids import encoder

LENGTH = 2048
#: Pieces are packed by their length in units of so many ids, rounded up.
UNIT = 8
#: The linear program is solved to within this share of its optimum.
GAP = 0.001
#: How far the duals are drawn towards the best feasible ones.
STEADY = 0.8
#: Rows of a task that share one counter of ranks.
RUN = 16_384


def knapsack(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of items that fits, by dynamic programming over the room."""
    use = np.flatnonzero(values > 1e-12)
    use = use[np.argsort(sizes[use], kind="stable")]
    worth, size = values[use], sizes[use]
    fitting = np.searchsorted(size, np.arange(room + 1), side="right")
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for space in range(1, room + 1):
        best[space] = best[space - 1]
        n = fitting[space]
        if n:
            gain = best[space - size[:n]] + worth[:n]
            k = gain.argmax()
            if gain[k] > best[space] + 1e-12:
                best[space], last[space] = gain[k], k
    pattern, space = np.zeros(len(values), int), room
    while space > 0:
        if last[space] < 0:
            space -= 1
            continue
        pattern[use[last[space]]] += 1
        space -= size[last[space]]
    return float(best[room]), pattern


def fill(sizes: np.ndarray, left: np.ndarray, room: int) -> np.ndarray:
    """A pattern with the largest item left that fills the room best (subset sums, larger items first).

    A sum's bit is set in the mask of the first item that reaches it.
    """
    pattern = np.zeros(len(sizes), int)
    first = int(np.flatnonzero(left)[0])
    pattern[first] = 1
    space = room - int(sizes[first])
    spare = left.copy()
    spare[first] -= 1
    reach, news, full = 1, [], (1 << (space + 1)) - 1
    for k in np.flatnonzero(spare):
        for _ in range(min(int(spare[k]), space // int(sizes[k]))):
            new = (reach << int(sizes[k])) & full & ~reach
            if not new:
                break
            news.append((int(k), new))
            reach |= new
            if reach >> space & 1:
                break
        if reach >> space & 1:
            break
    at = reach.bit_length() - 1
    for k, new in reversed(news):
        if new >> at & 1:
            pattern[k] += 1
            at -= int(sizes[k])
    return pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots; a driver process must not start the linear algebra
    library's own threads beside the session's."""
    n = len(matrix)
    both = np.concatenate([matrix, np.eye(n)], 1)
    for k in range(n):
        top = k + int(np.abs(both[k:, k]).argmax())
        both[[k, top]] = both[[top, k]]
        both[k] /= both[k, k]
        factors = both[:, k].copy()
        factors[k] = 0
        both -= factors[:, None] * both[k]
    return both[:, n:]


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often to use each, for the linear cutting-stock program.

    Revised simplex from the patterns of one size each; the column that enters
    is priced by the knapsack of the duals. The demand of every size is met
    exactly, in fractions. The duals are drawn towards the best feasible ones so
    far, which give a lower bound. Stops within GAP of that bound, or after a
    number of steps in proportion to the sizes with what is then feasible.
    """
    m = len(sizes)
    columns = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    amount = inverse @ demand
    bound, centre = 0.0, inverse.sum(0)
    for step in range(1, 8 * m):
        if step % 256 == 0:
            inverse = inverted(columns)
            amount = np.maximum(inverse @ demand, 0)
        duals = inverse.sum(0)
        for trial in (STEADY * centre + (1 - STEADY) * duals, duals):
            value, pattern = knapsack(trial, sizes, room)
            feasible = trial / max(value, 1.0)
            if feasible @ demand > bound:
                bound, centre = float(feasible @ demand), feasible
            if duals @ pattern > 1 + 1e-7:
                break
        else:
            break
        if amount.sum() <= bound * (1 + GAP):
            break
        column = pattern.astype(float)
        move = inverse @ column
        rows = move > 1e-9
        if not rows.any():
            break
        ratio = np.where(rows, amount / np.where(rows, move, 1), np.inf)
        leave = int(ratio.argmin())
        amount = np.maximum(amount - ratio[leave] * move, 0)
        amount[leave] = ratio[leave]
        pivot = inverse[leave] / move[leave]
        inverse -= np.outer(move, pivot)
        inverse[leave] = pivot
        columns[:, leave] = column
    return columns.T.astype(int), amount


def patterns_for(demand: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns ({size: items}, copies) that hold exactly the demanded items.

    The linear program's amounts are rounded down; each pattern for the few items
    left over takes the largest of them and what fills the rest best.
    """
    sizes = np.array(sorted((s for s, n in demand.items() if n > 0), reverse=True), int)
    if not len(sizes):
        return []
    left = np.array([demand[int(s)] for s in sizes])
    out = []
    columns, amounts = column_generation(sizes, left.astype(float), room)
    for column, amount in zip(columns, amounts, strict=True):
        used = column > 0
        copies = min(int(amount + 1e-6), int((left[used] // column[used]).min()))
        if copies > 0:
            left = left - copies * column
            out.append(({int(s): int(a) for s, a in zip(sizes[used], column[used], strict=True)}, copies))
    while left.any():
        pattern = fill(sizes, left, room)
        used = pattern > 0
        copies = int((left[used] // pattern[used]).min())
        left = left - copies * pattern
        out.append(({int(s): int(a) for s, a in zip(sizes[used], pattern[used], strict=True)}, copies))
    return out


@dataclass(frozen=True)
class Packed:
    """pieces: (key, doc_id, start, length, doc_tokens, ids); placement: the same rows without
    ids, with sequence_id and offset."""

    pieces: DataFrame
    placement: DataFrame

    def sequences(self) -> DataFrame:
        """(sequence_id, length, ids): each sequence's ids joined, without its padding."""
        parts = self.placement.select("key", "sequence_id", "offset").join(
            self.pieces.select("key", "ids", "length"), "key"
        )
        whole = parts.groupBy("sequence_id").agg(
            F.sum("length").alias("length"),
            F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
        )
        return whole.select(
            "sequence_id",
            "length",
            F.aggregate("parts.ids", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x)).alias("ids"),
        )


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int, id_col: str, text_col: str) -> DataFrame:
    """The written table of pieces: full sequences of each document, then what remains."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    names = ["key", "doc_id", "start", "length", "doc_tokens", "size", "run", "rank", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back_memory()
        encode_all = encoder(tokenizer).encode_all
        base = TaskContext.get().partitionId() << 33
        ranks: dict[int, int] = {}
        done = 0
        for batch in slices(batches, "text"):
            ids, totals = encode_all(batch.column(1), end_id)
            pieces = -(-totals // length)
            begin = np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = (np.arange(len(begin)) - begin) * length
            total = np.repeat(totals, pieces)
            size = np.minimum(length, total - start)
            units = -(-size // UNIT)
            keys = base + done + np.arange(len(size))
            rank = []
            for at, unit in enumerate(units.tolist(), done):
                if at % RUN == 0:
                    ranks.clear()
                rank.append(ranks.get(unit, 0))
                ranks[unit] = rank[-1] + 1
            done += len(size)
            ends = np.concatenate([[0], np.cumsum(4 * size)])
            cut = pa.Array.from_buffers(
                pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)]
            ).cast(pa.binary())
            doc_ids = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), pieces)))
            numbers = [start, size, total, units, keys // RUN, rank]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), doc_ids, *[pa.array(c, pa.int64()) for c in numbers], cut], names
            )

    schema = ", ".join(f"{n} long" for n in names[:-1]) + ", ids binary"
    return written(rows.mapInArrow(run, schema), "pieces")


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Packed:
    """Pack every document's ids, each followed by ``end_id``, into sequences of ``length``.

    A document is cut every ``length`` ids; its last piece is shorter. The
    histogram of the pieces' lengths in units of UNIT ids (at most length / UNIT
    numbers) goes to the driver, which finds the patterns; pieces of a size are
    ranked (by task, then order in it) and the ranks are dealt to the patterns'
    slots. No row is grouped by its size in one task: ranks are counted within
    runs of RUN pieces, and only one row for each run and size is summed up.

    A null or empty text is the end id alone. Repeated rows are packed each by
    itself; extra columns are left out; an empty table gives no piece.
    """
    pieces = cut_pieces(docs, tokenizer, end_id, length, id_col, text_col)
    room = length // UNIT
    counts = pieces.groupBy("size", "run").agg(F.count("*").alias("n"))
    demand = {r["size"]: r.n for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    slots, sequence, used = [], 0, dict.fromkeys(demand, 0)
    for pattern, copies in patterns_for(demand, room):
        for size, items in pattern.items():
            slots.append((size, used[size], used[size] + copies * items, items, sequence))
            used[size] += copies * items
        sequence += copies
    spark = docs.sparkSession
    table = spark.createDataFrame(slots, "size long, low long, high long, items long, base long")
    earlier = W.partitionBy("size").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("size", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = (
        pieces.withColumn("ids_crc32", F.crc32("ids"))
        .drop("ids")
        .join(bases, ["size", "run"])
        .withColumn("rank", F.col("before") + F.col("rank"))
    )
    inside = W.partitionBy("sequence_id").orderBy(F.desc("size"), "rank")
    placement = (
        ranked.join(F.broadcast(table), "size")  # at most room rows for each pattern's basis column
        .where("rank >= low and rank < high")
        .withColumn("sequence_id", F.expr("base + (rank - low) div items"))
        .withColumn(
            "offset",
            F.coalesce(F.sum("length").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        )
    )
    columns = ["key", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return Packed(pieces, placement.select(*columns))


def packed_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The placement of every piece, without its key."""
    return without(pack(docs, tokenizer, id_col=id_col, text_col=text_col).placement, ["key"])
