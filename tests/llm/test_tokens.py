import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm_cases import mixed
from wardhouse.llm import merge_scan, packing, pieces, token_files, token_ids
from wardhouse.llm.token_ids import Encoder, tokenizer_path

ODD = " \t\n  　᠎\x1c\x85ab'sLßé1.!中́Ġ"


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    out = ["", " ", "<|endoftext|>", "a <|endoftext|> b", "it's  we're\n\nnot 12.5%", "x" * 3000]
    for _ in range(n):
        text = "".join(rng.choice(ODD) for _ in range(rng.randrange(0, 16)))
        out.append(text.replace("!", rng.choice(["!", "<|endoftext|>", " don't "])))
    return out


def test_encoder_equals_the_library(bpe):
    mine, library = Encoder(bpe), Tokenizer.from_file(bpe)
    assert mine.safe
    for text in odd_texts(4000) + [mixed(300, k) for k in range(5)]:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kept", [500_000, 40])
def test_many_texts_at_once_equal_the_library(bpe, monkeypatch, kept):
    monkeypatch.setattr(token_ids, "KEPT_PIECES", kept)
    monkeypatch.setattr(token_ids, "GATHERED", 97)
    mine, library = Encoder(bpe), Tokenizer.from_file(bpe)
    rng = random.Random(kept)
    texts = odd_texts(3000, seed=2) + [mixed(300, k) for k in range(5)] + ["", "plain words\nand a line\n\nmore"]
    rng.shuffle(texts)
    at = 0
    while at < len(texts):
        some = texts[at : at + rng.randrange(1, 400)]
        want = [library.encode(t, add_special_tokens=False).ids for t in some]
        for end in (None, 7):
            ids, counts = mine.encode_all(pa.array(some), end)
            tail = [] if end is None else [end]
            assert counts.tolist() == [len(w) + len(tail) for w in want]
            assert ids.tolist() == [i for w in want for i in w + tail]
        at += len(some)
    ids, counts = mine.encode_all(pa.array([], pa.string()), 1)
    assert len(ids) == len(counts) == 0
    mine.safe = False
    ids, counts = mine.encode_all(pa.array(["some text", ""]), 1)
    assert ids.tolist() == library.encode("some text", add_special_tokens=False).ids + [1, 1]


@pytest.mark.parametrize("width", [1, 8])
def test_blocks_round_trip(width):
    rng = np.random.default_rng(0)
    for ids in ([0], [0, 0, 0], rng.integers(0, 50_257, 5000), rng.integers(0, 1 << 32, 77), np.empty(0)):
        ids = np.array(ids, np.uint32)
        assert (token_files.unpack_block(token_files.pack_block(ids, width)) == ids).all()
    index = token_files.pack_index(3, [(0, 0, 5), (100, 5, 2)], [(None, 4), (-7, 3)])
    number, blocks, ids, counts = token_files.read_index(index + b"\n")
    assert (number, blocks.tolist(), ids, counts.tolist()) == (3, [[0, 0, 5], [100, 5, 2]], [None, -7], [4, 3])


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(k, mixed(k * 7 % 900, k), "x") for k in range(150)]
    rows += [(500, None, "x"), (501, "", "x"), (None, "no id", "x"), (7, mixed(49, 7), "x"), (600, mixed(40_000, 3), "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, start string")


def ids_of(library, text, end):
    return library.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("width", [1, 8])
def test_token_files(spark, texts, bpe, tmp_path, width):
    library = Tokenizer.from_file(bpe)
    path = str(tmp_path / "files")
    token_files.write_token_files(texts, path, bpe, width=width)
    rows = token_files.read_token_files(spark, path).orderBy("start").collect()
    want = [(r.doc_id, ids_of(library, r.text, 0)) for r in texts.collect()]
    key = lambda d: (d is not None, d or 0)
    assert [key(r.doc_id) for r in rows] == sorted(key(d) for d, _ in want)
    start = 0
    for r in rows:
        assert r.start == start and r.n_tokens * 4 == len(r.ids)
        assert np.frombuffer(r.ids, "<u4").tolist() in [i for d, i in want if d == r.doc_id]
        start += r.n_tokens
    assert start == sum(len(i) for _, i in want)


def test_token_files_of_nothing(spark, empty_docs, bpe, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(empty_docs, path, bpe)
    assert token_files.read_token_files(spark, path).count() == 0


def test_patterns_hold_what_is_asked():
    rng = np.random.default_rng(1)
    for _ in range(20):
        room = 64
        demand = {int(s): int(n) for s, n in zip(rng.choice(np.arange(1, 65), 12, False), rng.integers(1, 400, 12))}
        found = packing.patterns_for(demand, room)
        held = {}
        for pattern, copies in found:
            assert sum(s * n for s, n in pattern.items()) <= room
            for s, n in pattern.items():
                held[s] = held.get(s, 0) + n * copies
        assert held == demand
        sizes = np.array(sorted(demand, reverse=True))
        _, amounts = packing.column_generation(sizes, np.array([float(demand[int(s)]) for s in sizes]), room)
        assert sum(c for _, c in found) <= amounts.sum() + 12
        assert amounts.sum() >= sum(s * n for s, n in demand.items()) / room - 1e-6
    assert packing.patterns_for({}, 64) == []


def test_knapsack_is_the_best():
    sizes, values = np.array([7, 5, 3]), np.array([7.5, 5.2, 2.9])
    value, pattern = packing.knapsack(values, sizes, 16)
    every = [
        (a * 7.5 + b * 5.2 + c * 2.9) for a in range(3) for b in range(4) for c in range(6) if 7 * a + 5 * b + 3 * c <= 16
    ]
    assert abs(value - max(every)) < 1e-9 and pattern @ sizes <= 16 and abs(pattern @ values - value) < 1e-9


def test_packing(spark, texts, bpe, empty_docs):
    library = Tokenizer.from_file(bpe)
    packed = packing.pack(texts, bpe)
    rows = packed.placement.collect()
    want = [(r.doc_id, ids_of(library, r.text, 1)) for r in texts.collect()]
    assert sum(r.length for r in rows) == sum(len(i) for _, i in want)
    by_sequence, pieces_of = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        pieces_of.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert any(d == r.doc_id and crc(i[r.start : r.start + r.length]) == r.ids_crc32 for d, i in want)
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    for (_, total), found in pieces_of.items():
        assert sum(r.length for r in found) % total == 0
    used = sum(r.length for r in rows)
    assert used > 0.9 * 2048 * len(by_sequence)
    lengths = {r.sequence_id: (r.length, len(r.ids) // 4) for r in packed.sequences().collect()}
    assert lengths == {s: (sum(r.length for r in f),) * 2 for s, f in by_sequence.items()}
    assert packing.packed_documents(empty_docs, bpe).count() == 0


@pytest.fixture(scope="module")
def model():
    return tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def words(model):
    return pieces.Vocabulary.load(model)


def all_segmentations(words, text):
    """Every segmentation's score and piece lengths from the end."""
    if not text:
        return [(0, ())]
    out = []
    for n in range(1, min(len(text), words.longest) + 1):
        last = text[-n:]
        score = words.scores.get(last)
        if score is None:
            if n > 1:
                continue
            score = words.unknown
        out += [(s + score, (n, *path)) for s, path in all_segmentations(words, text[:-n])]
    return out


def test_best_segmentation_by_brute_force(words):
    rng = random.Random(4)
    for _ in range(120):
        text = "".join(rng.choice("thean ing\nß日") for _ in range(rng.randrange(0, 11)))
        ready = words.prepared(text)
        every = all_segmentations(words, ready)
        best = max(every, key=lambda p: (p[0], p[1]))
        score, ids = words.encode(ready)
        assert score == best[0]
        assert words.decode(ids) == text
        _, back = words.forward(ready, 0, len(ready))
        if "\n" not in text and not words.parts(ready)[1:]:
            assert pieces._lengths(back, 0, len(ready)) == best[1]


def whole_and_scanned(words, text, chunk):
    ready = words.prepared(text)
    count = max(len(ready) // chunk, 1)
    sizes = [chunk] * (count - 1) + [len(ready) - (count - 1) * chunk]
    parts = [ready[k * chunk : k * chunk + s + words.longest - 1] for k, s in enumerate(sizes)]
    matrices = [pieces.chunk_matrix(words, p, s) for p, s in zip(parts, sizes)]
    found = pieces.states(matrices, 0, 0)
    if len(matrices) > 2:  # in two halves, as the levels do
        half = len(matrices) // 2
        sums = []
        for some in (matrices[:half], matrices[half:]):
            total = some[0]
            for m in some[1:]:
                total = pieces.combine(total, m)
            sums.append(total)
        middle = pieces.states(sums, 0, 0)[1]
        assert found == pieces.states(matrices[:half], 0, middle) + pieces.states(matrices[half:], middle, 0)[1:]
    score = sum(int(m[0][a, b]) for m, a, b in zip(matrices, found, found[1:]))
    ids = [i for p, s, a, b in zip(parts, sizes, found, found[1:]) for i in pieces.chunk_ids(words, p, s, a, b)]
    return words.encode(ready), (score, b"".join(ids))


@pytest.mark.parametrize("by_words", [True, False])
def test_scan_equals_the_whole(words, by_words):
    import dataclasses

    own = dataclasses.replace(words, by_words=by_words, kept={})
    rng = random.Random(2)
    for k in range(150):
        text = "".join(rng.choice("theanin g   \n▁é日x") for _ in range(rng.randrange(1, 300)))
        if k % 2:
            text = rng.choice(["a", "ab ", "  ", "the", "   x"]) * rng.randrange(1, 90)
        whole, scanned = whole_and_scanned(own, text, rng.choice([16, 17, 23, 50]))
        assert whole == scanned


def test_encode_and_decode(spark, model, words, texts, empty_docs):
    more = spark.createDataFrame(
        [(700, "a" * 5000, "x"), (701, " lead ▁ and  two\n", "x"), (702, " " * 900, "x")], texts.schema
    )
    docs = texts.union(more)
    rows = pieces.decode(
        pieces.encode(docs.selectExpr("doc_id", "text", "text as original", "start"), model, giant=600, chunk=100), model
    ).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.text == (r.original or "")
        assert (r.score, r.ids) == words.encode(words.prepared(r.original or ""))
    assert pieces.encode(empty_docs, model).count() == 0


def test_chunks_stay_where_they_are(spark, model, words, texts, monkeypatch):
    monkeypatch.setattr(pieces, "FAN", 2)
    some = [(k, mixed(900, k)) for k in range(3)]
    docs = spark.createDataFrame(some, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = pieces.encode(docs, model, giant=600, chunk=100, merges=True)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The chunks meet their states by a broadcast, and the scan's small groups keep their tasks.
    assert re.search(r"BroadcastHashJoin \[row#\d+L, chunk#\d+L\]", plan)
    assert "REPARTITION_BY_NUM" in plan
    assert {r.doc_id: (r.score, r.ids) for r in rows.collect()} == {
        k: words.encode_merged(words.prepared(t)) for k, t in some
    }


def merged_by_chunks(words, text, chunk):
    ready = words.prepared(text)
    count = max(len(ready) // chunk, 1)
    chunks = []
    for k in range(count):
        size = chunk if k < count - 1 else len(ready) - k * chunk
        lead = min(words.longest, k * chunk)
        chunks.append(merge_scan.Chunk(words, ready[k * chunk - lead : k * chunk + size + words.longest - 1], lead, size))
    middles = [words.encode_merged(c.middle) for c in chunks]
    matrices = [merge_scan.unpack(merge_scan.pack(c.matrix(m[0]))) for c, m in zip(chunks, middles)]
    found = merge_scan.states(matrices, merge_scan.FRESH, merge_scan.FRESH)
    left, right = matrices[0], matrices[-1]
    for m in matrices[1:]:
        left = merge_scan.combine(left, m)
    for m in matrices[-2::-1]:
        right = merge_scan.combine(m, right)
    assert left.tolist() == right.tolist()  # associative
    ends = [merge_scan.FRESH] * 2
    ids = b"".join(c.ids(a, b, m[1]) for c, a, b, m in zip(chunks, found, found[1:], middles))
    return next(s for *e, s in left.T.tolist() if e == ends), ids


def test_merge_scan_equals_the_library(words, model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(6)
    stems = ["a", "ab ", "  ", "the", "   x", "internationalization", "==", "ing\n"]
    ends = ["the", "ing", "er", "station", "al", "e", "s", "tion", "in"]
    for k in range(300):
        if k % 3 == 0:
            text = "".join(rng.choice("theanin g   \n▁é日x") for _ in range(rng.randrange(1, 400)))
        elif k % 3 == 1:
            text = rng.choice(stems) * rng.randrange(1, 90)
        else:  # one part over many chunks
            text = "".join(rng.choice(ends) for _ in range(rng.randrange(1, 90)))
        found = merged_by_chunks(words, text, rng.choice([words.longest, words.longest + 1, 23, 64]))
        assert found == words.encode_merged(words.prepared(text))
        if "▁" not in text:
            assert np.frombuffer(found[1], "<u4").tolist() == library.encode(text)


@pytest.mark.parametrize("kept", [500_000, 30])
def test_many_texts_merged_at_once(words, model, monkeypatch, kept):
    import dataclasses

    import sentencepiece

    monkeypatch.setattr(pieces, "KEPT", kept)
    monkeypatch.setattr(pieces, "AT_ONCE", 5_000)
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    own = dataclasses.replace(words, kept_merged={}, kept_pairs={})
    rng = random.Random(8)
    some = ["", " ", "     ", "\n", "\n\n  \n", "日本 ßx é", "x" * 65, "a" * 64 + " " + "ab" * 32, "the  people\n walk "]
    some += ["".join(rng.choice("theanin g    \né日xs.,") for _ in range(rng.randrange(0, 200))) for _ in range(500)]
    for texts in (some, [*some[:50], "a ▁ b", "nul \0 in it"], []):
        ids, scores = own.merge_all([own.prepared(t) for t in texts])
        want = [own.encode_merged(own.prepared(t)) for t in texts]
        assert ids.to_pylist() == [i for _, i in want] and scores.tolist() == [s for s, _ in want]
        for t, i in zip(texts, ids.to_pylist()):
            if "▁" not in t and "\0" not in t:
                assert np.frombuffer(i, "<u4").tolist() == library.encode(t)
        back = own.decode_all(pa.array([*ids.to_pylist(), None], pa.binary()))
        assert back.to_pylist() == [*texts, None]


def test_merges_equal_the_library(spark, model, words, texts, empty_docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(3)
    some = ["the", "this", "able", "  two  blanks ", "a\nb \n c", "aaaaaaaaa" * 700, " " * 900, "日ßx é"]
    some += ["".join(rng.choice("theanin g   \né日xs.,") for _ in range(rng.randrange(1, 300))) for _ in range(300)]
    some += ["the people walk along this able river " * 60]
    for text in some:
        ids = words.encode_merged(words.prepared(text))[1]
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)
    docs = texts.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(some, 1000)), "doc_id long, text string"))
    rows = pieces.encode(docs, model, giant=600, chunk=100, merges=True).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text or "")
        assert (r.score, r.ids) == words.encode_merged(words.prepared(r.text or ""))
    assert pieces.encode(empty_docs, model, merges=True).count() == 0
