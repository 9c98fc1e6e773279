import hashlib
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from wardhouse.llm import warc
from wardhouse.session import work_path

SCHEMA = "page_id long, url string, html string, record_type string, key string"


def plain_records(rows, least=100):
    """(page_id, bytes, digest, type, refers_to) of each row, by sorting the rows of one payload."""
    groups = {}
    for page, url, html, *_ in rows:
        groups.setdefault((html or "").encode(), []).append((page is None, page or 0, url is None, url or "", page))
    out = []
    for payload, members in groups.items():
        members.sort(key=lambda m: m[:4])
        for k, member in enumerate(members):
            again = len(payload) >= least and k > 0
            out.append(
                (member[4], len(payload), hashlib.sha256(payload).hexdigest(),
                 "revisit" if again else "response", members[0][4] if again else None)
            )
    return sorted(out, key=repr)


def cases():
    rng = random.Random(8)
    bodies = [f"<p>{'é' * rng.randrange(200)}{k}</p>" * rng.randrange(1, 5) for k in range(30)]
    rows = []
    for k in range(400):
        host = rng.choice(["a.org", "www.b.org", "b.org", "deep.sub.c.net:8080", "ex ample", "d.org"])
        url = f"http{rng.choice(['', 's'])}://{host}/{rng.randrange(60)}?q={rng.randrange(3)}#f"
        rows.append((k, url, rng.choice(bodies) if k % 3 else f"<html>{'own page ' * 30}{k}", "x", "y"))
    same = "one payload of very many pages " * 9
    rows += [(1000 + k, "http://hot.org/", same, None, None) for k in range(200)]
    rows += [(900, None, same, None, None), (None, "http://hot.org/", same, None, None), (None, None, same, None, None)]
    rows += [(1005, "http://hot.org/", same, "x", "y"), (900, None, same, "x", "y"), (900, "", same, "x", "y")]
    rows += [(2000, "http://e.org/\r\nX: 1%0A", None, "x", "y"), (2001, "", "", "x", "y"), (2002, None, None, "x", "y")]
    rows += [(2003, "HTTP://User@E.ORG:80/Caps", "\r\n\r\nWARC/1.1\n\n" * 20, "x", "y"), (2004, "u", "é" * 50, "x", "y")]
    rows += [(2005, "v", "é" * 50, "x", "y"), (2006, "w", "z" * 99, "x", "y"), (2007, "w", "z" * 99, "x", "y")]
    rows += [(2008, "http://long.org", "long text\n" * 400_000, "x", "y"), (2009, None, "\ufeff\U0001f600" * 60, "x", "y")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def archives(spark):
    path = work_path(spark, "warc")
    rows = cases()
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    return path, rows


def shown(df):
    got = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted((tuple(r) for r in got), key=repr)


def test_records_by_brute_force(spark, archives):
    path, rows = archives
    assert shown(warc.read_archives(spark, path, payloads=False)) == plain_records(rows)


def test_payloads_come_back(spark, archives):
    path, rows = archives
    captures = warc.read_archives(spark, path)
    got = warc.resolved(captures).select("page_id", "url", F.decode("payload", "utf-8").alias("html")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], r[1], r[2] or "") for r in rows), key=repr)
    assert captures.select("record_id").distinct().count() == len(rows)
    visits = captures.where("record_type = 'revisit'")
    assert visits.where("payload is not null").count() == 0
    known = captures.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"))
    assert visits.join(known, "refers_to_record", "left_anti").count() == 0


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_RECORDS", 3)
    path, rows = work_path(spark, "warc"), cases()
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path, least_bytes=10)
    assert shown(warc.read_archives(spark, path)) == plain_records(rows, 10)
    assert spark.read.parquet(f"{path}/directory").agg(F.max("n"), F.sum("n")).first() == (3, len(rows))
    check_look_up(spark, path, rows)


def check_look_up(spark, path, rows):
    urls = ["https://hot.org", "http://A.org/7?q=1", "http://b.org/9?q=0", "http://www.b.org/9?q=0", "http://none.org/",
            "http://e.org:80/Caps", "http://deep.sub.c.net:8080/5?q=2", "zzz", "http://hot.org/#again", None, "aaa"]
    asked = spark.createDataFrame([(u,) for u in urls], "url string")
    keys = {r.key for r in asked.select(warc.url_key(F.col("url")).alias("key")).collect()} - {""}
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("key", warc.url_key(F.col("url")))
    want = sorted(((r.key, r.page_id) for r in pages.collect() if r.key in keys), key=repr)
    got = warc.look_up(spark, path, asked).collect()
    assert sorted(((r.key, r.page_id) for r in got), key=repr) == want
    assert len(want) > 200


def test_look_up(spark, archives):
    check_look_up(spark, *archives)


def test_look_up_reads_only_what_it_needs(spark, archives, monkeypatch):
    path, _ = archives
    block = spark.read.parquet(f"{path}/directory").orderBy("first_key").first()
    read = []

    class Counted:
        def __init__(self, file):
            self.file = file

        def read_at(self, length, at):
            read.append(length)
            return self.file.read_at(length, at)

        def size(self):
            return self.file.size()

    with warc._opened(block.path) as file:
        lines = warc._directory(Counted(file))
        assert sum(read) < file.size() / 10 and [line[0] for line in lines] == sorted(line[0] for line in lines)


def test_find():
    lines = [("b", "d"), ("d", "d"), ("d", "f"), ("h", "k")]
    assert warc.find(lines, ["a", "b", "c", "d", "e", "g", "h", "z"]) == {0: ["b", "c", "d"], 1: ["d"], 2: ["d", "e"], 3: ["h"]}
    assert warc.find([], ["a"]) == {}


def test_keys(spark):
    urls = {
        "http://www.Example.org/A?b=C#d": "org,example,www)/A?b=C",
        "https://u:p@example.org:443": "org,example)/",
        "http://example.org:8080?x": "org,example:8080)/?x",
        "example.org/a://b": "org,example)/a://b",
        "": ")/",
    }
    rows = spark.createDataFrame([(u,) for u in [*urls, None]], "url string")
    assert {r.url: r.key for r in rows.withColumn("key", warc.url_key(F.col("url"))).collect()} == urls | {None: ""}


def test_files_are_plain_archives(spark, archives):
    """Any zstandard reader sees WARC records one after another, in key order."""
    path, rows = archives
    seen = 0
    for r in spark.read.format("binaryFile").load(f"{path}/archives").where("length > 0").collect():
        text = zstandard.ZstdDecompressor().stream_reader(r.content, read_across_frames=True).read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        while text:
            head, _, rest = text.partition(b"\r\n\r\n")
            length = int(head.rsplit(b"Content-Length: ", 1)[1])
            assert head.startswith(b"WARC/1.1\r\n") and rest[length : length + 4] == b"\r\n\r\n"
            text = rest[length + 4 :]
            seen += b"WARC-Type: warcinfo" not in head
    assert seen == len(rows)


def test_damage_is_found():
    record = warc.pack_record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), "urn:uuid:1")
    assert warc.unpack_record(record)[:3] == (1, "u", "response")
    with pytest.raises(ValueError, match="not what was stored"):
        warc.unpack_record(record.replace(b"payload\r", b"paylaod\r"))
    with pytest.raises(ValueError, match="not a WARC record"):
        warc.unpack_record(record[:-1])


def test_no_pages(spark):
    path = work_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0
    asked = spark.createDataFrame([("http://a.org",)], "url string")
    assert warc.look_up(spark, path, asked).count() == 0
