"""All a row breaks from one read; shared shuffles of checks; the gate's figures."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardhouse import contracts as C
from wardhouse.operators import checks, findings, joins
from wardhouse.operators.dedup import latest_per_key, ranked, superseded
from wardhouse.operators.fingerprint import differences, fingerprint, merged
from wardhouse.plans.work import ALL_CODES, checked, work


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def consultations(spark):
    rng = random.Random(6)
    rows = []
    for k in range(300):
        start = rng.choice([None, "2026-04-29 09:00:00", "2026-04-29 10:00:00"])
        end = rng.choice([None, "2026-04-29 09:30:00", "2026-04-29 11:00:00"])
        rows.append((
            rng.choice([None, 0, *range(1, 40)]), rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2, 9]), start,
            end, rng.choice([None, 37.0]), rng.choice(["C", "F", "K", None]),
            rng.choice([None, ["INDIC_DIABETE"], ["TEMP_PATIENT", "ID_TRAITEMENT"]]), k % 7 if k % 2 else 0,
        ))
    rows += rows[:40]
    schema = ("consultation_id long, staff_id long, patient_id long, started_at string, ended_at string,"
              " patient_temperature double, temperature_unit string, _wrong_types array<string>, treatment_id long")
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "ended_at")})


def parents(spark):
    return {
        "PERSONNEL": spark.createDataFrame([(1,), (2,)], "staff_id long"),
        "PATIENT": spark.createDataFrame([(1,), (9,), (5,)], "patient_id long"),
    }


def plain(rows):
    """Findings of each row by hand, without those of versions."""
    out = []
    for r in rows:
        found = []
        def say(bad, code, note):
            if bad:
                found.append((code, note))
        say(r.consultation_id is None, "NULL_MANDATORY", "consultation_id is missing")
        say(r.consultation_id is not None and r.consultation_id <= 0, "WRONG_FORMAT", "consultation_id is not above zero")
        for c in ("patient_id", "staff_id", "started_at", "ended_at"):
            say(r[c] is None, "NULL_MANDATORY", f"{c} is missing")
        say(None not in (r.started_at, r.ended_at) and r.ended_at < r.started_at, "WRONG_FORMAT", "ended_at is before started_at")
        kinds = {"INDIC_DIABETE": "boolean", "TEMP_PATIENT": "decimal(38,0)", "ID_TRAITEMENT": "integer"}
        for c in r._wrong_types or []:
            say(True, "WRONG_TYPE", f"{c} is not of type {kinds[c]}")
        say(r.patient_temperature is not None and r.temperature_unit not in ("C", "F"), "NORM_FAILURE", "temperature_unit is neither C nor F")
        say(r.staff_id is not None and r.staff_id not in (1, 2), "FK_NOT_FOUND", "no parent for staff_id")
        say(r.patient_id is not None and r.patient_id not in (1, 9, 5), "FK_NOT_FOUND", "no parent for patient_id")
        out.append(found)
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_every_finding_of_every_row(spark, monkeypatch, hot):
    if hot:  # as where tables are too large to broadcast and some keys hold many rows
        monkeypatch.setattr(findings, "small", lambda df: False)
    rows = consultations(spark)
    table = C.CONSULTATION
    got = checked(rows, table, parents(spark)).collect()
    later = "a later version of consultation_id was kept"
    business = [c for c in rows.columns if c != "_wrong_types"]
    want, have = Counter(), Counter()
    for r, found in zip(rows.collect(), plain(rows.collect())):
        want[(tuple(r[c] for c in business), tuple(found))] += 1
    for r in got:
        own = tuple(tuple(f) for f in r.findings if f["note"] != later)
        have[(tuple(r[c] for c in business), own)] += 1
        held = any(code in findings.HOLDING for code, _ in own)
        late = any(f["note"] == later for f in r.findings)
        assert not (held and late)
        assert r.wrk_stts_cd == ("REJ" if held or late else "OK")
        first = next((f["code"] for f in r.findings if f["code"] in (*findings.HOLDING, "DUPLICATE_PK")), None)
        assert r.rej_cod == (first if held or late else None)
        assert r.fate == ("superseded" if late else "noted" if r.findings else "clean")
    assert have == want
    # Accepted and rejected rows are those of the gate; the others are the rows it drops.
    staged = rows.drop("_wrong_types")
    gate = work(staged, table)
    shown = [r for r in got if r.fate != "superseded"]
    key = lambda r: repr([r[c] for c in (*business, "wrk_stts_cd", "rej_cod")])
    assert sorted(map(key, shown)) == sorted(map(key, gate.collect()))
    accepted = staged.join(spark.createDataFrame([], "x int"), F.lit(False), "left_anti")
    accepted = accepted.filter(~F.coalesce(F.expr(" OR ".join(f"({r.failing})" for r in table.rules)), F.lit(False)))
    lost = {repr([r[c] for c in business]): r.copies for r in superseded(accepted, ["consultation_id"], table.latest_by).collect()}
    dropped = Counter(repr([r[c] for c in business]) for r in got if r.fate == "superseded")
    assert dropped == lost
    copies = Counter((repr([r[c] for c in business]), r.copy) for r in got if r.fate == "noted" and r.wrk_stts_cd == "REJ")
    assert max(copies.values()) == 1


def test_strict_rejects_for_everything(spark):
    got = checked(consultations(spark).withColumn("patient_weight_kg", F.lit(70)), C.CONSULTATION, parents(spark), strict=True)
    for r in got.collect():
        assert (r.wrk_stts_cd == "REJ") == bool(r.findings) and r.fate != "superseded"
        assert r.rej_cod is None or r.rej_cod in ALL_CODES


def test_a_staged_table_is_read_once(spark, tmp_path):
    consultations(spark).write.parquet(str(tmp_path / "staged"))
    for name, df in parents(spark).items():
        df.write.parquet(str(tmp_path / name))
    held = {n: spark.read.parquet(str(tmp_path / n)) for n in ("PERSONNEL", "PATIENT")}
    text = plan(checked(spark.read.parquet(str(tmp_path / "staged")), C.CONSULTATION, held))
    assert text.count("FileScan") == 3
    # One shuffle on the key; the parents are small and broadcast.
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text


def test_ranked_hot_keys(spark):
    rows = [(1, k % 5, "x") for k in range(400)] + [(k, 1, "y") for k in range(2, 60)] + [(None, 3, "z")] * 50
    df = spark.createDataFrame(rows, "id long, v int, s string").repartition(4)
    for among in (F.lit(True), F.col("v") != 4):
        got = ranked(df, ["id"], ["v DESC"], among, "kept", "copy")
        kept = got.filter("kept").drop("kept", "copy")
        want = latest_per_key(df.filter(among), ["id"], ["v DESC"])
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, want.collect()))
        assert got.count() == len(rows)
    assert joins.hot_keys(df, ["id"])


def test_no_sketch_before_a_small_dimension(spark, monkeypatch, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "d"))
    dimension = spark.read.parquet(str(tmp_path / "d"))
    facts = spark.range(50).withColumn("x", F.lit(1))
    looked = []
    monkeypatch.setattr(joins, "hot_keys", lambda *a: looked.append(a) or {})
    assert joins.join_dimension(facts, dimension, ["id"]).count() == 50 and not looked
    assert "BroadcastHashJoin" in plan(joins.join_dimension(facts, dimension, ["id"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins.join_dimension(facts, dimension, ["id"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert looked


def test_repeated_keys_share_a_shuffle(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(30)]), rng.choice("abcde"), k) for k in range(60)]
    df = spark.createDataFrame(rows, "a long, b string, c long")
    sets = [("a",), ("a", "b"), ("c",), ("b", "c")]
    got = {r.key_set: r.n_failed for r in checks.repeated_keys(df, sets).collect()}
    want = {}
    for n, keys in enumerate(sets):
        repeated = checks.duplicate_keys(df, keys).agg(F.sum("cnt")).first()[0]
        if repeated:
            want[n] = repeated
    assert got == want and 2 not in got
    assert checks.repeated_keys(df, [("b",)], "c < 1").count() == 0
    df.write.parquet(str(tmp_path / "t"))
    text = plan(checks.repeated_keys(spark.read.parquet(str(tmp_path / "t")), sets))
    # The second read meets only the keys whose hash repeats.
    assert text.count("FileScan") == 2 and "LeftSemi" in text


def test_lost_rows_of_all_references_to_a_parent(spark):
    parent = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y")], "p int, q string")
    one = spark.createDataFrame([(1, "x"), (3, "x"), (3, "x"), (None, "x")], "a long, b string")
    two = spark.createDataFrame([(2, "y", 1), (2, "z", 1), (9, "z", 0)], "a long, b string, w int")
    got = checks.lost_by_parent(
        parent, ("p", "q"), [(one, ("a", "b"), None), (two, ("a", "b"), "w = 1"), (one, ("a", "b"), "a < 3")]
    )
    assert plan(got).count("Exchange hashpartitioning(_k0") == 1
    assert {r.child: r.n_failed for r in got.collect()} == {0: 2, 1: 1}


def test_fingerprints_merge_and_compare(spark):
    rows = [(k % 4, k, f"s{k % 7}", None if k % 5 else 1) for k in range(200)]
    df = spark.createDataFrame(rows, "d int, v long, s string, w int")
    args = (["v", "w"], ["s"], ["v", "s", "w"])
    parts = fingerprint(df, ["d"], *args)
    assert differences(merged(parts), fingerprint(df, (), *args)).count() == 0
    shuffled = df.orderBy(F.rand()).repartition(5)
    assert differences(fingerprint(shuffled, ["d"], *args), parts, ["d"]).count() == 0
    other = df.withColumn("s", F.when((F.col("v") == 8), "t").otherwise(F.col("s"))).filter("d < 3")
    found = differences(parts, fingerprint(other, ["d"], *args), ["d"]).collect()
    assert {(r.d, r.figure) for r in found if r.d < 3} == {(0, "max_s"), (0, "row_hash")}
    assert {r.figure for r in found if r.d == 3} == {"n_rows", "sum_v", "sum_w", "min_s", "max_s", "row_hash"}
