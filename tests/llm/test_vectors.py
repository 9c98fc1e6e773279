import hashlib
import math
import random

import numpy as np
import pytest

from wardhouse.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def plain_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    """{row: (code, error)} and the codebooks' digest, one point and entry at a time."""
    kept = [
        (i, r) for i, r in enumerate(rows)
        if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    size = parts * -(-max(len(r[1]) for _, r in kept) // parts)
    wide = size // parts
    whole = {}
    for i, r in kept:
        q = [math.floor(scale * float(np.float32(x))) for x in r[1]]
        whole[i] = q + [0] * (size - len(q))
    order = sorted(kept, key=lambda t: (t[1][0] is None, t[1][0] or 0, [float(np.float32(x)) for x in t[1][1]]))
    books = [[whole[i][p * wide : (p + 1) * wide] for i, _ in order[:entries]] for p in range(parts)]

    def nearest(part, point):
        return min((sum((a - b) ** 2 for a, b in zip(point, e)), k) for k, e in enumerate(books[part]))

    def assign():
        return {i: [nearest(p, q[p * wide : (p + 1) * wide]) for p in range(parts)] for i, q in whole.items()}

    for _ in range(rounds):
        met = {}
        for i, found in assign().items():
            for p, (_, k) in enumerate(found):
                met.setdefault((p, k), []).append(whole[i][p * wide : (p + 1) * wide])
        for (p, k), points in met.items():
            books[p][k] = [sum(c) // len(points) for c in zip(*points)]
    out = {
        i: ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)) for i, found in assign().items()
    }
    text = ",".join(str(x) for part in books for e in part for x in e)
    return out, hashlib.sha256(text.encode()).hexdigest()


def cases(size, n, seed=1):
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(0, 0.2) for _ in range(size)], rng.choice([1, 2, None]), "x", "y") for k in range(n)]
    rows += [(n, list(rows[3][1]), 2, None, None), (3, rows[3][1], 1, "x", "y"), (None, rows[5][1], None, "x", "y")]
    rows += [
        (n + 1, None, 1, "x", "y"),
        (n + 2, [None] + [0.1] * (size - 1), 1, "x", "y"),
        (n + 3, [float("nan")] * size, 1, "x", "y"),
        (n + 4, [float("-inf")] * size, 3, "x", "y"),
        (n + 5, [0.0] * size, 4, "x", "y"),
        (n + 6, [-0.001] * size, 4, "x", "y"),
    ]
    rng.shuffle(rows)
    return rows


def check(spark, rows):
    got = vc.vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want, digest = plain_codes(rows)
    of_label = {}
    for i, (_, error) in want.items():
        of_label[rows[i][2]] = of_label.get(rows[i][2], 0) + error
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    expected = [(rows[i][0], rows[i][2], c, e, of_label[rows[i][2]], digest) for i, (c, e) in want.items()]
    assert sorted(map(key, (tuple(r) for r in got))) == sorted(map(key, expected))


@pytest.mark.parametrize(("size", "n"), [(64, 300), (16, 200), (32, 30)])
def test_codes_by_brute_force(spark, size, n):
    check(spark, cases(size, n))


def test_uneven_and_empty_vectors_are_padded(spark):
    rows = cases(20, 80) + [(500, [], 1, "x", "y"), (501, [0.5, 0.25], 2, "x", "y")]
    check(spark, rows)
    check(spark, [(1, [], None, "x", "y"), (2, [], 1, "x", "y")])


def test_few_and_no_vectors(spark):
    check(spark, [(7, [0.1] * 16, None, "x", "y")])
    none = vc.vector_codes(spark.createDataFrame([(1, None, 1, "x", "y")], SCHEMA))
    assert none.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert none.count() == 0
    assert vc.vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 4, 12])
def test_memo_never_changes_a_result(size, monkeypatch):
    rng = np.random.default_rng(size)
    entries = rng.integers(-300, 300, (64, size))
    entries[10] = entries[20]
    points = np.concatenate([rng.integers(-900, 900, (3000, size)), entries, entries + 1])
    far = ((points[:, None, :] - entries) ** 2).sum(2)
    for kept in (20_000, 50):  # the second empties the memo again and again
        monkeypatch.setattr(vc, "KEPT_CELLS", kept)
        memo = vc.CellMemo(entries)
        for chunk in np.array_split(np.arange(len(points)), 40):
            index, error = memo.nearest(points[chunk])
            assert (index == far[chunk].argmin(1)).all() and (error == far[chunk].min(1)).all()
    # Cells whose hashes meet are told apart.
    memo = vc.CellMemo(entries)
    memo.mix[:] = 0
    index, error = memo.nearest(points)
    assert (index == far.argmin(1)).all() and (error == far.min(1)).all()


def test_cells_leave_entries_out():
    rng = np.random.default_rng(3)
    memo = vc.CellMemo(rng.integers(-300, 300, (64, 4)))
    memo.nearest(rng.integers(-300, 300, (2000, 4)))
    assert memo.many.mean() < 20


def test_many_groups_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(vc, "FEW_GROUPS", 0)
    check(spark, cases(16, 60))


def test_decode(spark):
    rows = cases(16, 40)
    df = spark.createDataFrame(rows, SCHEMA)
    books = vc.fit(df)
    for r in vc.encode(df, books, keep=("embedding",)).collect():
        whole = np.floor(256 * np.array(r.embedding))
        assert ((whole / 256 - books.decode(r.code)) ** 2).sum() * 256**2 == pytest.approx(r.error)


def test_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30] * 16, 1, "x", "y")], SCHEMA)
    with pytest.raises(Exception, match="64-bit"):
        vc.vector_codes(df).collect()
