"""Records over several lines are put together by chunks of lines."""

import random

import pytest
from pyspark.sql import functions as F
from test_splits import extract

from wardhouse.sources import batch_files


@pytest.mark.parametrize("chunk", [1, 7])
def test_records_over_chunks(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(batch_files, "CHUNK", chunk, raising=True)
    rng = random.Random(chunk)
    for part in range(2):
        (tmp_path / f"part-{part}.txt").write_text(extract(rng, 40), encoding="utf-8", newline="")
    whole = (
        spark.read.options(**batch_files.CSV_OPTIONS).option("multiLine", "true")
        .schema(batch_files.text_schema(["id", "note", "last"])).csv(str(tmp_path))
    )
    want = sorted((tuple(r) for r in whole.collect() if r.id.strip()), key=repr)
    got = batch_files.read_text_table(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_no_task_sorts_a_whole_split(spark, tmp_path):
    (tmp_path / "T.txt").write_text('id;note\n1;"x\ny"\n2;z\n')
    lines = batch_files._lines(spark, str(tmp_path))
    plan = lines.groupBy("file", "block").agg(F.min_by("value", "place"))
    assert "SortAggregate" in plan._jdf.queryExecution().executedPlan().toString()
    plan = batch_files.split_states(lines)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    records = batch_files.text_records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "chunk" in records.split("Window [")[1].split("\n")[0]
