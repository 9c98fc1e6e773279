import corpus_pipeline
import pytest

from llm_cases import BAD, GOOD, RUDE, mixed
from wardhouse.llm.common import written


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small documents table with every case the stages decide on."""
    docs, labels = [], []
    for k in range(240):
        good, toxic = k % 3 != 0, k % 4 == 1
        text = f"{GOOD} {mixed(40, k)}" if good else f"{BAD} {mixed(10, k)}"
        docs.append((k, text + (f" {RUDE} {mixed(5, k + 1000)}" if toxic else "")))
        labels.append((k, int(good), int(toxic)))
    base = f"{GOOD} {mixed(120, 5000)}"
    docs += [(300, base), (301, base), (302, base.replace("quiet", "silent")), (303, f"{GOOD} {mixed(90, 5001)} jo@x.org")]
    docs += [(304, f"{GOOD} {mixed(3000, 5002)}"), (305, base)]
    path = tmp_path_factory.mktemp("tables")
    rows = [(d, t, "en", f"s{d % 3}", len(t)) for d, t in docs]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kinds).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "near_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, [{r.doc_id for r in docs.collect()}]
    frames = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder), name)
        assert docs.columns == columns
        frames.append(docs.collect())
        ids.append({r.doc_id for r in frames[-1]})
    toxic = {k for k in range(240) if k % 4 == 1}
    bad = {k for k in range(0, 240, 3)}
    assert len((ids[0] - ids[1]) ^ toxic) <= 3 and ids[1] >= {300, 303, 304}
    assert len((ids[1] - ids[2]) ^ (bad - toxic)) <= 5 and ids[2] >= {300, 303, 304}
    assert ids[3] >= {300, 303, 304} and not ids[3] & {301, 302, 305}
    assert ids[4] == ids[3] and len(frames[3]) == len(ids[3])
    changed = next(r for r in frames[3] if r.doc_id == 303)
    assert "jo@x.org" not in changed.text and changed.n_chars == len(changed.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == ids[4]
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, predicted int"
    good = f"{GOOD} {mixed(50, 1)}"
    rows = [
        (1, good, None, None, None, "s", 1, 2),
        (1, good, None, None, None, "s", 1, 2),
        (2, None, "en", "a", 0, None, None, None),
        (3, "", "en", "a", 0, "s", 1, 2),
        (None, f"{GOOD} {mixed(50, 2)}", "en", "a", 0, "s", 1, 2),
        (4, f"{GOOD} {mixed(60_000, 3)}", "en", "a", 0, "s", 1, 2),
    ]
    docs = spark.createDataFrame(rows, kinds)
    out = stage(spark, docs, folder).collect()
    if name == "packing":
        assert {r.doc_id for r in out} == {1, 2, 3, 4, None}
    else:
        assert set(out[0].asDict()) == set(docs.columns)
        assert sum(r.doc_id == 1 for r in out) == (1 if name == "near_dedup" else 2)
        assert all(r.score == "s" for r in out if r.doc_id != 2)
        assert {4, None} <= {r.doc_id for r in out}
    nothing = spark.createDataFrame([], kinds)
    assert stage(spark, nothing, folder).count() == 0
