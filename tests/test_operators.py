"""Gates, deduplication, upserts, joins, keys and occupancy on hand-made rows."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardhouse import contracts as C
from wardhouse.operators import occupancy
from wardhouse.operators.dedup import latest_per_key, ordering, superseded
from wardhouse.operators.joins import hot_keys, hot_keys_of, join_dimension
from wardhouse.operators.load import upsert, upsert_counts
from wardhouse.operators.quality import check_rows, gate
from wardhouse.operators.references import check_references
from wardhouse.operators.surrogate import dense_key

T9, T10 = "2026-01-01 09:00:00", "2026-01-01 10:00:00"


def text_gate(spark, table, base, change):
    row = {**base, **change}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    got = check_rows(df, C.TEXT_RULES[table]).first()
    return got["wrk_stts_cd"], got["rej_cod"]


OK = ("OK", None)
NULL = ("REJ", C.NULL_MANDATORY)
WRONG = ("REJ", C.WRONG_FORMAT)
CONSULT = dict(consultation_id="1", patient_id="10", staff_id="20", started_at=T9, ended_at=T10)
TREAT = dict(treatment_id="1", consultation_id="10", medicine_code="MED001",
             medicine_category="ANALGESIQUE", manufacturer_brand="BRAND_A",
             dosage_description="1", medicine_quantity="2")
STAY = dict(hospi_id="1", consultation_id="10", room_number="101", responsible_staff_id="5",
            started_at=T9, ended_at=T10, cost="350.0")


@pytest.mark.parametrize(
    ("table", "base", "change", "want"),
    [
        ("CONSULTATION", CONSULT, {}, OK),
        ("CONSULTATION", CONSULT, {"ended_at": None}, NULL),
        ("CONSULTATION", CONSULT, {"ended_at": T9}, OK),
        ("CONSULTATION", CONSULT, {"started_at": T10, "ended_at": T9}, WRONG),
        ("CONSULTATION", CONSULT, {"started_at": "soon"}, WRONG),
        ("CONSULTATION", CONSULT, {"started_at": "2026"}, WRONG),
        ("CONSULTATION", CONSULT, {"ended_at": "later"}, WRONG),
        ("CONSULTATION", CONSULT, {"consultation_id": "0"}, WRONG),
        ("CONSULTATION", CONSULT, {"consultation_id": "-3"}, WRONG),
        ("CONSULTATION", CONSULT, {"consultation_id": "True"}, WRONG),
        ("CONSULTATION", CONSULT, {"consultation_id": None, "patient_id": None}, NULL),
        ("CONSULTATION", CONSULT, {"consultation_id": "x", "patient_id": None}, WRONG),
        ("CONSULTATION", CONSULT, {"patient_id": None}, NULL),
        ("CONSULTATION", CONSULT, {"staff_id": None}, NULL),
        ("TRAITEMENT", TREAT, {}, OK),
        ("TRAITEMENT", TREAT, {"medicine_quantity": None}, OK),
        ("TRAITEMENT", TREAT, {"dosage_description": None}, NULL),
        ("TRAITEMENT", TREAT, {"treatment_id": "abc"}, WRONG),
        ("HOSPITALISATION", STAY, {}, OK),
        ("HOSPITALISATION", STAY, {"ended_at": None}, OK),
        ("HOSPITALISATION", STAY, {"cost": "-0.01"}, WRONG),
        ("HOSPITALISATION", STAY, {"cost": "free"}, OK),
        ("HOSPITALISATION", STAY, {"cost": None}, OK),
        ("HOSPITALISATION", STAY, {"responsible_staff_id": None}, NULL),
        ("HOSPITALISATION", STAY, {"started_at": T10, "ended_at": T9}, WRONG),
    ],
)
def test_text_rules(spark, table, base, change, want):
    assert text_gate(spark, table, base, change) == want


def test_gate_keeps_the_latest_and_every_reject(spark):
    rows = [
        (1, "a", datetime(2026, 1, 1)), (1, "b", datetime(2026, 1, 2)),
        (1, None, datetime(2026, 1, 3)), (None, "c", None), (None, "d", None), (0, "e", None),
    ]
    df = spark.createDataFrame(rows, "id long, name string, at timestamp_ntz")
    rules = (*C.required("id"), C.positive("id"), *C.required("name"))
    got = gate(df, rules, ["id"], ["at DESC NULLS LAST"], date(2026, 4, 29), 7, describe=True)
    rows = sorted(
        ((r["id"], r["name"], r["wrk_stts_cd"], r["rej_cod"], r["rej_dsc"]) for r in got.collect()),
        key=repr,
    )
    assert rows == sorted(
        [
            (1, "b", "OK", None, None),
            (1, None, "REJ", "NULL_MANDATORY", "name is missing"),
            (None, "c", "REJ", "NULL_MANDATORY", "id is missing"),
            (None, "d", "REJ", "NULL_MANDATORY", "id is missing"),
            (0, "e", "REJ", "WRONG_FORMAT", "id is not above zero"),
        ],
        key=repr,
    )
    assert {(r["batch_dt"], r["exec_id"]) for r in got.collect()} == {(date(2026, 4, 29), 7)}


def test_sort_terms(spark):
    with pytest.raises(ValueError):
        ordering(["drop table"])


def test_latest_does_not_depend_on_row_order(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([None, 1, 2]), rng.choice(["x", "y", None])) for k in [1] * 60 + [2] * 5]
    results = set()
    for _ in range(3):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k long, v long, s string").repartition(4)
        got = latest_per_key(df, ["k"], ["v DESC NULLS LAST"])
        results.add(tuple(sorted(map(tuple, got.collect()))))
    assert len(results) == 1


def test_superseded_rows_with_copies(spark):
    rows = [(1, "a", 1)] * 5 + [(1, "b", 2)] * 3 + [(2, "c", 1)] + [(3, None, None)] * 2
    df = spark.createDataFrame(rows, "k long, s string, v long").repartition(3)
    got = superseded(df, ["k"], ["v DESC NULLS LAST"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, "a", 1, 5), (1, "b", 2, 2), (3, None, None, 1)], key=repr
    )


def naive_upsert(target, batch, guarded):
    """Row by row, as the reference semantics say."""
    out = {r[0]: r for r in target if r[0] is not None}
    loose = [r for r in target if r[0] is None]
    latest = {}
    for r in batch:
        if r[0] is None:
            loose.append(r)
            continue
        key = (0 if r[1] is not None else 1, -(r[1] or 0), r[2] or "~") if guarded else (
            (0, r[1]) if r[1] is not None else (1, 0), r[2] or "~")
        if r[0] not in latest or key < latest[r[0]][0]:
            latest[r[0]] = (key, r)
    for k, (_, r) in latest.items():
        old = out.get(k)
        newer = old and r[1] is not None and old[1] is not None and r[1] > old[1]
        if old is None or not guarded or newer:
            out[k] = r
    return sorted([*out.values(), *loose], key=repr)


@pytest.mark.parametrize("guarded", [True, False])
def test_upsert_against_brute_force(spark, guarded):
    rng = random.Random(11)
    pick = lambda n: rng.choice([None, *range(n)])
    target = [(k, pick(5), rng.choice("ab")) for k in range(20)] + [(None, 1, "t")]
    batch = [(pick(40), pick(5), rng.choice("xyz")) for _ in range(60)]
    schema = "id long, at long, s string"
    guard = "at" if guarded else None
    t, b = spark.createDataFrame(target, schema), spark.createDataFrame(batch, schema)
    once = upsert(t, b, ["id"], guard)
    got = sorted(map(tuple, once.collect()), key=repr)
    assert got == naive_upsert(target, batch, guarded)
    keyed = b.filter("id IS NOT NULL")
    first = upsert(t, keyed, ["id"], guard)
    twice = upsert(first, keyed, ["id"], guard)
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(
        map(tuple, first.collect()), key=repr
    )
    counts = upsert_counts(t, b, ["id"], guard).first().asDict()
    loose = sum(r[0] is None for r in batch)
    new = {r[0] for r in batch if r[0] is not None} - {r[0] for r in target}
    assert counts["read_rows"] == 60 and counts["inserted_rows"] == len(new) + loose
    changed = set(got) - set(target)
    assert counts["affected_rows"] >= len([c for c in changed if c[0] is not None]) - loose


def test_upsert_on_composite_keys(spark):
    schema = "a string, b string, v long"
    target = spark.createDataFrame([("x", "1", 1), ("x", "2", 2), ("x", None, 3)], schema)
    batch = spark.createDataFrame([("x", "1", 10), ("x", None, 30), ("y", "1", 40)], schema)
    got = sorted(map(tuple, upsert(target, batch, ["a", "b"]).collect()), key=repr)
    assert got == sorted(
        [("x", "1", 10), ("x", "2", 2), ("x", None, 3), ("x", None, 30), ("y", "1", 40)], key=repr
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_hot_keys_are_spread_without_changing_the_join(spark, how):
    ids = [7] * 4000 + [None] * 3000 + list(range(1000)) + [5000]
    facts = spark.createDataFrame(list(enumerate(ids)), "n long, k long").repartition(5)
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = hot_keys(facts, ["k"])
    assert sorted(hot.values()) == [2, 3]
    # A dimension that is broadcast needs no shares.
    plain = join_dimension(facts, dim, ["k"], how, spread_by=["n"])
    assert "_share" not in plain._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_dimension(facts, dim, ["k"], how, spread_by=["n"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = facts.join(dim, ["k"], how)
    assert joined.columns == want.columns
    assert joined.exceptAll(want).isEmpty() and want.exceptAll(joined).isEmpty()
    assert "_share" in joined._jdf.queryExecution().analyzed().toString()
    small = facts.filter("k IS NOT NULL AND k <> 7")
    assert hot_keys(small, ["k"]) == {}
    with pytest.raises(ValueError):
        join_dimension(facts, dim.withColumn("k", F.col("k").cast("int")), ["k"])


def test_as_many_hot_keys_as_partitions_are_found(spark):
    """300 equally hot keys at 1,000 partitions, found for two sets of keys in one pass."""
    facts = spark.range(60_000).select((F.col("id") % 300).alias("k"), F.col("id").alias("n"))
    facts = facts.withColumn("one", F.lit(1).cast("bigint")).repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        by_key, by_one = hot_keys_of(facts, [["k"], ["one"]])
        assert len(by_key) == 300 and set(by_key.values()) == {4} and list(by_one.values()) == [1000]
        dim = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = join_dimension(facts, dim, ["k"], spread_by=["n"], hot=by_key)
        plan = joined._jdf.queryExecution().analyzed().toString()
        assert "map(" not in plan and "_shares" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert joined.agg(F.count("*"), F.sum("v")).first()[:] == (60_000, sum(2 * k * 200 for k in range(300)))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_dense_keys(spark, partitions):
    rng = random.Random(3)
    rows = list({(rng.choice("abc"), rng.choice([None, *"xyz"]), rng.randrange(50)) for _ in range(300)})
    df = spark.createDataFrame(rows, "a string, b string, c long").repartition(4)
    got = dense_key(df, ["a", "b", "c"], "sk", partitions).orderBy("sk").collect()
    assert [r["sk"] for r in got] == list(range(1, len(rows) + 1))
    last = lambda v: (v is None, v or "")  # noqa: E731 - NULLs sort last
    want = sorted(rows, key=lambda r: (r[0], last(r[1]), r[2]))
    assert [tuple(r)[:3] for r in got] == want


def test_dense_keys_of_nothing(spark):
    df = spark.createDataFrame([], "a string")
    assert dense_key(df, ["a"], "sk").count() == 0


def test_occupancy_against_brute_force(spark):
    rng = random.Random(9)
    day0 = datetime(2025, 12, 20)
    stays = []
    for _ in range(300):
        start = day0 + timedelta(hours=rng.randrange(24 * 120))
        end = rng.choice([None, start + timedelta(hours=rng.randrange(24 * 70))])
        if rng.random() < 0.9 and end is None:
            end = start
        stays.append((rng.randrange(30), start, end))
    stays += [(None, day0, None), (31, datetime(2030, 1, 1), None), (32, datetime(2020, 1, 1), datetime(2020, 2, 1))]
    days = sorted({(day0 + timedelta(days=10 + rng.randrange(80))).date() for _ in range(40)})
    consults = spark.createDataFrame(
        [(datetime.combine(d, datetime.min.time()) + timedelta(hours=5),) for d in days] + [(None,)],
        "at timestamp_ntz",
    )
    rooms = spark.range(40).select(F.col("id").alias("room"), F.lit("x").alias("name"))
    df = spark.createDataFrame(stays, "room long, s timestamp_ntz, e timestamp_ntz")
    cal = occupancy.calendar(consults, "at")
    taken = occupancy.taken_days(df, "room", "s", "e", cal)
    got = occupancy.day_grid(rooms, "room", cal, taken).collect()
    used = defaultdict(set)
    for room, s, e in stays:
        for d in days:
            if room is not None and s.date() <= d and (e is None or e.date() >= d):
                used[room].add(d)
    want = {(d, r): int(d in used[r]) for d in days for r in range(40)}
    assert {(r["report_date"], r["room"]): r["is_taken"] for r in got} == want
    assert len(got) == len(want)


def test_occupancy_without_consultations(spark):
    none = spark.createDataFrame([], "at timestamp_ntz")
    stays = spark.createDataFrame([(1, datetime(2026, 1, 1), None)], "room long, s timestamp_ntz, e timestamp_ntz")
    cal = occupancy.calendar(none, "at")
    taken = occupancy.taken_days(stays, "room", "s", "e", cal)
    rooms = spark.createDataFrame([(1,)], "room long")
    assert occupancy.day_grid(rooms, "room", cal, taken).count() == 0


def test_references(spark):
    rows = spark.createDataFrame(
        [(1, 5, "OK", None, None), (2, 6, "OK", None, None), (3, 9, "REJ", "NULL_MANDATORY", None),
         (4, None, "OK", None, None)],
        "id long, k long, wrk_stts_cd string, rej_cod string, rej_dsc string",
    )
    parent = spark.createDataFrame(
        [(5, True, "OK"), (6, False, "OK"), (9, True, "REJ")], "k long, hot boolean, wrk_stts_cd string"
    )
    ref = C.Reference(("k",), "P", ("k",), parent_filter="hot")
    got = {r["id"]: (r["wrk_stts_cd"], r["rej_cod"], r["rej_dsc"])
           for r in check_references(rows, [ref], {"P": parent}).collect()}
    assert got == {
        1: ("OK", None, None), 2: ("REJ", "FK_NOT_FOUND", "no parent for k"),
        3: ("REJ", "NULL_MANDATORY", None), 4: ("OK", None, None),
    }
