"""Token-id files: ids in fixed-size blocks, split into planes, each plane compressed.

A file is a sequence of records, each closed by one line feed (which is not
counted in its length):

    magic ``BPS1`` | kind (u8) | plane width in bits (u8) | planes (u16)
    | count (u32) | body length (u64) | body

Kind 0 is a block of at most BLOCK ids. Its body is the compressed length (u32)
of each plane, then the planes. Plane k holds bits [k * width, (k + 1) * width)
of every id, in id order, packed to bytes and compressed with zstandard. Planes
above the largest id of the block are left out.

Kind 2, the last record, has the file's number and its count of ids (u64 each,
big endian), so that a file can be placed by its last bytes. Kind 1, before it,
is the index: zstandard over the file's number (u64),
the number of blocks and of documents (u64 each), then for each block its byte
offset, first id and count (u64 each), and for each document its id (i64),
whether that id is null (u8) and its count of ids (u64), column after column.
All other numbers are little endian.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardhouse.llm.common import slices
from wardhouse.llm.token_ids import encoder

MAGIC = b"BPS1"
HEAD = "<4sBBHIQ"
HEAD_BYTES = struct.calcsize(HEAD)
#: Ids in a block.
BLOCK = 65_536
LEVEL = 1
#: Up to so many files their places, 16 bytes each, are broadcast; more are joined by shuffle.
FEW_FILES = 100_000


def pack_block(ids: np.ndarray, width: int = 8) -> bytes:
    """A block's record: its ids, transposed into planes of ``width`` (1 or 8) bits."""
    ids = np.ascontiguousarray(ids, "<u4")
    planes = -(-int(ids.max()).bit_length() // width) if len(ids) else 0
    table = ids.view(np.uint8).reshape(-1, 4)
    press = zstandard.ZstdCompressor(level=LEVEL)
    if width == 8:
        parts = [press.compress(np.ascontiguousarray(table[:, k])) for k in range(planes)]
    else:
        bits = np.unpackbits(table, axis=1, bitorder="little")
        parts = [press.compress(np.packbits(bits[:, k], bitorder="little")) for k in range(planes)]
    body = struct.pack(f"<{planes}I", *map(len, parts)) + b"".join(parts)
    return struct.pack(HEAD, MAGIC, 0, width, planes, len(ids), len(body)) + body


def unpack_block(record: bytes | memoryview) -> np.ndarray:
    magic, kind, width, planes, count, length = struct.unpack_from(HEAD, record)
    if magic != MAGIC or kind != 0 or width not in (1, 8):
        raise ValueError("not a block record")
    at = HEAD_BYTES + 4 * planes
    press = zstandard.ZstdDecompressor()
    table = np.zeros((count, 32 // width), np.uint8)
    for k, size in enumerate(struct.unpack_from(f"<{planes}I", record, HEAD_BYTES)):
        plane = np.frombuffer(press.decompress(bytes(record[at : at + size])), np.uint8)
        table[:, k] = plane if width == 8 else np.unpackbits(plane, count=count, bitorder="little")
        at += size
    return (table if width == 8 else np.packbits(table, axis=1, bitorder="little")).view("<u4").ravel()


def pack_index(number: int, blocks: list[tuple[int, int, int]], docs: list[tuple[int | None, int]]) -> bytes:
    body = struct.pack("<3Q", number, len(blocks), len(docs))
    body += np.array(blocks, "<u8").reshape(-1, 3).T.tobytes()
    body += np.array([d or 0 for d, _ in docs], "<i8").tobytes()
    body += np.array([d is None for d, _ in docs], "u1").tobytes()
    body += np.array([n for _, n in docs], "<u8").tobytes()
    body = zstandard.ZstdCompressor(level=LEVEL).compress(body)
    return struct.pack(HEAD, MAGIC, 1, 0, 0, len(docs), len(body)) + body


def read_index(content: bytes | memoryview) -> tuple[int, np.ndarray, list[int | None], np.ndarray]:
    """The file's number, its blocks (offset, first id, count), document ids and counts."""
    at = 0
    while True:
        magic, kind, _, _, _, length = struct.unpack_from(HEAD, content, at)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        if kind == 1:
            break
        at += HEAD_BYTES + length + 1
    body = zstandard.ZstdDecompressor().decompress(bytes(content[at + HEAD_BYTES : at + HEAD_BYTES + length]))
    number, n_blocks, n_docs = struct.unpack_from("<3Q", body)
    at = 24 + 24 * n_blocks
    blocks = np.frombuffer(body, "<u8", 3 * n_blocks, 24).reshape(3, -1).T
    ids = np.frombuffer(body, "<i8", n_docs, at).tolist()
    null = np.frombuffer(body, "u1", n_docs, at + 8 * n_docs)
    for k in np.flatnonzero(null).tolist():
        ids[k] = None
    return number, blocks, ids, np.frombuffer(body, "<u8", n_docs, at + 9 * n_docs)


def read_block(content: bytes | memoryview, blocks: np.ndarray, k: int) -> np.ndarray:
    return unpack_block(memoryview(content)[int(blocks[k][0]) :])


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    width: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text and write token-id files below ``path``, in id order.

    Each document's ids are followed by ``end_id``; a null or empty text is the
    end id alone. Rows are dealt into ranges of the id (a null id first; rows of
    one id are ordered by their texts, so that a frequent id is spread too) and
    each range becomes one file, written through Spark to any store that it
    reaches. An empty table gives no file with records. Other columns are not
    stored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["id", F.xxhash64("text"), "text"]
    ranges = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer).encode_all
        held, offset, first = bytearray(), 0, 0
        blocks, index = [], []

        def record(count: int) -> bytes:
            nonlocal offset, first
            out = pack_block(np.frombuffer(bytes(held[: 4 * count]), "<u4"), width)
            del held[: 4 * count]
            blocks.append((offset, first, count))
            offset, first = offset + len(out) + 1, first + count
            return out

        def rows_of(records: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"record": pa.array(records, pa.binary())})

        for batch in slices(batches, "text"):
            ids, counts = encode_all(batch.column(1), end_id)
            index += zip(batch.column(0).to_pylist(), counts.tolist(), strict=True)
            held.extend(ids.tobytes())
            while len(held) >= 4 * BLOCK:
                yield rows_of([record(BLOCK)])
        if held:
            yield rows_of([record(len(held) // 4)])
        if index:
            number = TaskContext.get().partitionId()
            total = struct.pack(">2Q", number, first)
            yield rows_of(
                [pack_index(number, blocks, index), struct.pack(HEAD, MAGIC, 2, 0, 0, 0, len(total)) + total]
            )

    records = ranges.mapInArrow(run, "record binary")
    # The text writer puts the bytes of a string out as they are, and a line feed after each.
    records.select(F.col("record").cast("string").alias("value")).write.text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files below ``path``.

    ``start`` counts the ids of all documents before it, in file order; ``ids``
    are little-endian unsigned 32-bit numbers. Files are placed by their
    last bytes; the ids are decoded block after block.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                view = memoryview(content.as_buffer())
                number, blocks, keys, counts = read_index(view)
                yield from decoded(view, number, blocks, keys, counts)

    def decoded(view, number, blocks, keys, counts) -> Iterator[pa.RecordBatch]:
        held, used, k, start = b"", 0, 0, 0
        rows, size = [], 0
        for key, count in zip(keys, counts.tolist(), strict=True):
            parts, left = [], 4 * count
            while left:
                if used == len(held):
                    held, used, k = read_block(view, blocks, k).tobytes(), 0, k + 1
                parts.append(held[used : used + left])
                used += len(parts[-1])
                left -= len(parts[-1])
            rows.append((number, key, start, count, b"".join(parts)))
            start += count
            size += count
            if size >= 1_000_000:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["file", "doc_id", "at", "n_tokens", "ids"]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    last = [F.hex(F.substring("content", F.length("content") - 16 + 8 * k, F.lit(8))) for k in (0, 1)]
    totals = files.select(*(F.conv(x, 16, 10).cast("long").alias(n) for x, n in zip(last, ("file", "total"), strict=True)))
    bases = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    if files.count() <= FEW_FILES:
        bases = F.broadcast(bases)
    docs = files.mapInArrow(documents, "file long, doc_id long, at long, n_tokens long, ids binary")
    return docs.join(bases, "file").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids"
    )
