"""Web archives with a two-level capture index.

A file is a zstandard stream. Each WARC/1.1 record is a frame of its own; a
skippable frame after it takes in the line feed that closes it in the file. Pages
lie in the order of their URL keys, so the index of a run of records follows them
as one compressed block, again inside a skippable frame. After the last block
comes the directory, one line for each block, and after that a trailer of fixed
size that says where the directory begins. A plain zstandard reader sees nothing
but the records.

An URL key is the reversed host, `)`, path and query: ``com,example,www)/a?b=1``.
A look-up finds the file, then the block, by binary search over first keys, reads
that block's bytes, searches it, and reads the bytes of the records it names.
Nothing else of the archives is read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardhouse.llm.common import written
from wardhouse.operators.joins import join_dimension

#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 100
#: A block of the index closes after so many records or bytes of records.
BLOCK_RECORDS, BLOCK_BYTES = 2000, 4_000_000
LEVEL = 3
#: Skippable frames: a line feed, a block, the directory, the trailer.
SKIP = 0x184D2A50
GAP, BLOCK, DIRECTORY, TRAILER = SKIP + 1, SKIP + 2, SKIP + 3, SKIP + 4
TRAIL = "<IIQQ"
#: The trailer in the file, with the line feed that closes it.
TRAIL_BYTES = struct.calcsize(TRAIL) + 1
#: Bytes of archives that one task reads, about.
TASK_BYTES = 64_000_000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

CAPTURE = (
    "page_id long, url string, record_type string, record_id string, refers_to long,"
    " refers_to_record string, payload_bytes long, payload_digest string, payload binary"
)


def url_key(url: Column) -> Column:
    """Reversed lower-case host, port unless 80 or 443, `)`, then path and query as they are.

    Scheme, user and fragment are left out; no path is ``/``; a null URL has the empty key.
    """
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"(?s)#.*$", "")
    authority = F.regexp_extract(rest, r"^[^/?]*", 0)
    named = F.lower(F.regexp_replace(authority, r"^.*@|:(80|443)?$", ""))
    port = F.regexp_extract(named, r":\d+$", 0)
    host = F.substring(named, F.lit(1), F.length(named) - F.length(port))
    tail = F.substring(rest, F.length(authority) + 1, F.length(rest))
    path = F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), path)
    return F.coalesce(key, F.lit(""))


def record_id(page_id: int | None, url: str | None, digest: str, repeat: int) -> str:
    """The same for the same capture in every run; ``repeat`` numbers equal rows."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([page_id, url, digest, repeat]))}"


def _line(name: str, value: object) -> bytes:
    text = str(value).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    return f"{name}: {text}\r\n".encode()


def _value(text: bytes) -> str:
    return text.decode().replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def pack_record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    digest: str,
    number: str,
    refers: tuple[int | None, str] | None = None,
    date: str = DATE,
) -> bytes:
    """One WARC record: a response, or a revisit of the page and record in ``refers``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + _line("Content-Length", len(payload))
    block = http + b"\r\n" + (b"" if refers else payload)
    lines = [b"WARC/1.1\r\n", _line("WARC-Type", "revisit" if refers else "response")]
    lines += [_line("WARC-Record-ID", f"<{number}>"), _line("WARC-Date", date)]
    if page_id is not None:
        lines.append(_line("X-Page-ID", page_id))
    if url is not None:
        lines.append(_line("WARC-Target-URI", url))
    lines.append(_line("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers:
        lines += [_line("WARC-Profile", REVISIT), _line("WARC-Refers-To", f"<{refers[1]}>")]
        if refers[0] is not None:
            lines.append(_line("X-Refers-To-Page", refers[0]))
    lines += [_line("Content-Type", "application/http;msgtype=response"), _line("Content-Length", len(block))]
    return b"".join([*lines, b"\r\n", block, b"\r\n\r\n"])


def unpack_record(record: bytes) -> tuple:
    """The fields of CAPTURE. A response's digest is taken from its payload and must be the stored one."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    fields = {n: _value(v) for n, _, v in (line.partition(b": ") for line in lines)}
    length = int(fields[b"Content-Length"])
    if first != b"WARC/1.1" or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    kind = fields[b"WARC-Type"]
    digest = fields[b"WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields[b'WARC-Record-ID']}: the payload is not what was stored")
    page, refers = fields.get(b"X-Page-ID"), fields.get(b"X-Refers-To-Page")
    return (
        None if page is None else int(page),
        fields.get(b"WARC-Target-URI"),
        kind,
        fields[b"WARC-Record-ID"][1:-1],
        None if refers is None else int(refers),
        fields[b"WARC-Refers-To"][1:-1] if kind == "revisit" else None,
        size,
        digest,
        payload if kind == "response" else None,
    )


def _packed(rows: list) -> bytes:
    text = "\n".join(json.dumps(r, ensure_ascii=False) for r in rows)
    return zstandard.ZstdCompressor(level=LEVEL).compress(text.encode())


def _unpacked(data: bytes) -> list:
    text = zstandard.ZstdDecompressor().decompress(data).decode()
    return [json.loads(line) for line in text.split("\n")]


class _Archive:
    """Gives out the parts of one file, each to be followed by a line feed, and keeps its directory."""

    def __init__(self, date: str):
        self.date = date
        self.press = zstandard.ZstdCompressor(level=LEVEL)
        self.at, self.start, self.entries, self.directory = 0, 0, [], []

    def _part(self, data: bytes) -> bytes:
        self.at += len(data) + 1
        return data

    def _skipped(self, kind: int, data: bytes) -> bytes:
        return self._part(struct.pack("<II", kind, len(data) + 1) + data)

    def framed(self, record: bytes) -> bytes:
        return self._part(self.press.compress(record) + struct.pack("<II", GAP, 1))

    def head(self) -> bytes:
        """The warcinfo record every file begins with."""
        block = b"format: WARC File Format 1.1\r\n"
        info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\n" + _line("WARC-Date", self.date)
        info += _line("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'warcinfo')}>")
        info += b"Content-Type: application/warc-fields\r\n" + _line("Content-Length", len(block))
        out = self.framed(info + b"\r\n" + block + b"\r\n\r\n")
        self.start = self.at
        return out

    def add(self, key: str, page_id: int | None, record: bytes) -> Iterator[bytes]:
        begin = self.at
        yield self.framed(record)
        self.entries.append((key, page_id, begin, self.at - begin))
        if len(self.entries) >= BLOCK_RECORDS or self.at - self.start >= BLOCK_BYTES:
            yield from self.close()

    def close(self) -> Iterator[bytes]:
        """The block of the records since the last one."""
        if self.entries:
            begin = self.at
            data = _packed(self.entries)
            self.directory.append(
                (self.entries[0][0], self.entries[-1][0], self.start, begin, begin + 8, len(data), len(self.entries))
            )
            yield self._skipped(BLOCK, data)
            self.start, self.entries = self.at, []

    def end(self) -> Iterator[bytes]:
        yield from self.close()
        begin = self.at
        data = _packed(self.directory)
        yield self._skipped(DIRECTORY, data)
        yield self._part(struct.pack(TRAIL, TRAILER, 17, begin + 8, len(data)))


def write_archives(
    pages: DataFrame,
    path: str,
    least_bytes: int = LEAST_BYTES,
    date: str = DATE,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
) -> None:
    """Write a record for every page below ``path``, with the index in the files and their
    directory as a table.

    Of pages with equal payloads of at least ``least_bytes`` that of the smallest
    id (null last, then by URL) is a response and the others revisit it; all
    smaller ones are responses. The payload is the body in UTF-8, nothing for a
    null. Equal rows have a record each. Rows are dealt into ranges of (key, id,
    digest), so that a frequent URL or payload is spread, and each range is one
    file, written through Spark to any store that it reaches. Which pages are
    revisits is found on (id, URL, digest) alone and meets the bodies in the
    shuffle into ranges, the only one that moves them. Other columns are not
    stored. An empty table gives no records.
    """
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("body")
    ).withColumn("digest", F.unhex(F.sha2("body", 256)))
    facts = written(rows.where(F.octet_length("body") >= least_bytes).drop("body"), "payloads")
    order = F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url")
    groups = facts.groupBy("digest").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    groups = groups.where("n > 1").select(
        "digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url")
    )
    others = join_dimension(facts, written(groups, "shared-payloads"), ["digest"], spread_by=["page_id", "url"])
    others = others.where(~(F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("url").eqNullSafe(F.col("refers_url"))))
    columns = ["key", "page_id", "url", "digest", "refers_to", "refers_url", "body"]
    bodies = rows.withColumns(
        {"refers_to": F.lit(None).cast("long"), "refers_url": F.lit(None).cast("string"), "key": url_key(F.col("url"))}
    )
    others = others.withColumns({"body": F.lit(None).cast("binary"), "key": url_key(F.col("url"))})
    both = others.distinct().select(*columns).unionAll(bodies.select(*columns))
    # A revisit's fact stands before its body: null is the least.
    ranges = both.repartitionByRange("key", "page_id", "digest").sortWithinPartitions(
        "key", "page_id", "url", "digest", F.col("body").isNotNull()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts(batches):
            held.append(part)
            size += len(part)
            if size >= BLOCK_BYTES:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    def batch_of(held: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array(held, pa.binary())})

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        archive = None
        met, refers, repeat = None, None, 0
        for batch in batches:
            for key, page, url, digest, to, to_url, body in zip(*batch.columns, strict=True):
                key, page, url, digest = key.as_py(), page.as_py(), url.as_py(), digest.as_py().hex()
                if not body.is_valid:
                    first = to.as_py()
                    met, refers, repeat = (page, url, digest), (first, record_id(first, to_url.as_py(), digest, 0)), 0
                    continue
                if met != (page, url, digest):
                    met, refers, repeat = (page, url, digest), None, 0
                if archive is None:
                    archive = _Archive(date)
                    yield archive.head()
                data, number = body.as_py(), record_id(page, url, digest, repeat)
                yield from archive.add(key, page, pack_record(page, url, data, digest, number, refers, date))
                repeat += 1
                # Rows equal to a response visit it again.
                if refers is None and len(data) >= least_bytes:
                    refers = (page, number)
        if archive:
            yield from archive.end()

    # The text writer puts the bytes of a string out as they are, and a line feed after each.
    filed = ranges.mapInArrow(run, "part binary")
    filed.select(F.col("part").cast("string").alias("value")).write.text(f"{path}/archives")
    _directories(pages.sparkSession, path).write.parquet(f"{path}/directory")


def _opened(path: str):
    """A file to read byte ranges of, by Arrow's file systems."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return store.open_input_file(name)


def _directory(file) -> list:
    """The lines of a file's directory: first and last key, where its records begin and end, where
    its block begins, the block's length, records."""
    trailer = file.read_at(TRAIL_BYTES, file.size() - TRAIL_BYTES)
    kind, _, at, length = struct.unpack_from(TRAIL, trailer)
    if kind != TRAILER:
        raise ValueError("not an archive with an index")
    return _unpacked(file.read_at(length, at))


def _directories(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(f"{path}/archives").where("length > 0").select("path")
    names = ["first_key", "last_key", "records_from", "records_to", "block_at", "block_length", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _opened(path) as file:
                    lines = _directory(file)
                yield pa.RecordBatch.from_pydict(
                    {"path": [path] * len(lines)} | dict(zip(names, map(list, zip(*lines, strict=True)), strict=True))
                )

    return files.mapInArrow(
        run,
        "path string, first_key string, last_key string, records_from long, records_to long,"
        " block_at long, block_length long, n long",
    )


def _batch_of(captures: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    columns = [pa.array(c, k) for c, k in zip(zip(*captures, strict=True), kinds)]
    last = [c[8] for c in captures] if payloads else [None] * len(captures)
    names = [f.split()[0] for f in CAPTURE.split(", ")]
    return pa.RecordBatch.from_arrays([*columns, pa.array(last, pa.binary())], names)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every capture in the archives below ``path`` (CAPTURE), found through the index.

    Tasks share the blocks of the directory; a block and the bytes of its records
    are read by range. A revisit has no payload of its own (see :func:`resolved`);
    with ``payloads`` false no row carries one, though each is read and checked.
    """
    blocks = spark.read.parquet(f"{path}/directory")
    total = blocks.agg(F.sum(F.col("records_to") - F.col("records_from"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                with _opened(row["path"]) as file:
                    entries = _unpacked(file.read_at(row["block_length"], row["block_at"]))
                    begin = row["records_from"]
                    data = memoryview(file.read_at(row["records_to"] - begin, begin))
                found, size = [], 0
                for _, _, at, length in entries:
                    found.append(unpack_record(press.decompress(data[at - begin : at - begin + length - 9])))
                    size += found[-1][6]
                    if size >= BLOCK_BYTES:
                        yield _batch_of(found, payloads)
                        found, size = [], 0
                if found:
                    yield _batch_of(found, payloads)

    return blocks.repartition(tasks, "path", "block_at").mapInArrow(run, CAPTURE)


def find(lines: list, keys: list[str]) -> dict[int, list[str]]:
    """Which of the sorted keys may lie in which line of a sorted list of (first, last, ...)."""
    firsts = [line[0] for line in lines]
    out: dict[int, list[str]] = {}
    for key in keys:
        # The last line that begins below the key may still end in it.
        at = max(bisect_left(firsts, key) - 1, 0)
        while at < len(lines) and firsts[at] <= key:
            if key <= lines[at][1]:
                out.setdefault(at, []).append(key)
            at += 1
    return out


def look_up(spark: SparkSession, path: str, urls: DataFrame, url_col: str = "url", payloads: bool = True) -> DataFrame:
    """The captures (CAPTURE, and the ``key`` they were found by) of the URLs in a table.

    URLs are alike when their keys are. The first and last key of every file, as
    many as the writing job had tasks, go to all tasks; keys are dealt to the
    files that may hold them, where directory and blocks are searched.
    """
    files = (
        spark.read.parquet(f"{path}/directory")
        .groupBy("path")
        .agg(F.min("first_key").alias("first"), F.max("last_key").alias("last"))
        .orderBy("first", "last")
    )
    listed = spark.sparkContext.broadcast([(r["first"], r["last"], r["path"]) for r in files.collect()])
    keys = urls.select(url_key(F.col(url_col)).alias("key")).where("key <> ''").distinct()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find(listed.value, sorted(batch.column(0).to_pylist()))
            rows = [(listed.value[at][2], key) for at, held in found.items() for key in held]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], ["path", "key"]
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            held: dict[str, list[str]] = {}
            for name, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(name, []).append(key)
            for name, wanted in held.items():
                with _opened(name) as file:
                    lines = _directory(file)
                    for at, some in sorted(find(lines, sorted(wanted)).items()):
                        entries = _unpacked(file.read_at(lines[at][5], lines[at][4]))
                        firsts = [e[0] for e in entries]
                        for key in some:
                            k = bisect_left(firsts, key)
                            while k < len(entries) and firsts[k] == key:
                                data = file.read_at(entries[k][3] - 9, entries[k][2])
                                row = _batch_of([unpack_record(press.decompress(data))], payloads)
                                yield row.append_column("key", pa.array([key], pa.string()))
                                k += 1

    dealt = keys.mapInArrow(deal, "path string, key string")
    return dealt.repartition("path", "key").sortWithinPartitions("path", "key").mapInArrow(read, f"{CAPTURE}, key string")


def resolved(captures: DataFrame) -> DataFrame:
    """Captures with every revisit's payload taken from the response that it refers to.

    The input holds both, with payloads. A response that much is referred to is
    repeated for shares of its revisits.
    """
    stored = captures.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("payload").alias("__stored")
    )
    visits = captures.where("record_type = 'revisit'")
    met = join_dimension(visits, stored, ["refers_to_record"], "left", spread_by=["record_id"])
    met = met.withColumn("payload", F.col("__stored")).select(*captures.columns)
    return captures.where("record_type = 'response'").unionByName(met)
