import re

import numpy as np
import pytest

from llm_cases import fold_of, odd_rows
from wardhouse.llm import compression, quality_rules, toxicity
from wardhouse.llm.linear import char_ngrams, distinct, isotonic, platt, sigmoid

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counters(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    hit = set()
    for k, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= set(range(k, k + 5))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dup = sum(line in lines[:k] for k, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


@pytest.mark.parametrize(
    "text",
    [
        "",
        "one two three",
        "a b c d e f a b c d e g",
        "x x x x x x x",
        "a\nb\na\n \n \nb #$|<é日\U0001f600",
        "a\x0bb\x0cc\x1cd\x85e",
        "\n".join(["the same line again and again", "another", "the same line again and again"] * 3),
    ],
)
def test_counters_match_the_definition(text):
    raw = text.encode()
    assert quality_rules.counters(text, raw, raw.split()) == plain_counters(text)


def test_distinct_buckets():
    found = char_ngrams("the theory of the thing", (3, 4), 12)
    scratch = np.zeros(1 << 12, np.int32)
    assert sorted(distinct(found, scratch)) == sorted(set(found.tolist()))
    assert len(char_ngrams("", (3, 4, 5, 6), 20)) == 0


def test_curves_rise():
    z = np.array([0.0, 0.1, 0.1, 0.2, 0.3, 0.4])
    y = np.array([0, 1, 0, 0, 1, 1])
    knots, rates = isotonic(z, y)
    assert knots == sorted(knots) and rates == sorted(rates) and 0 < rates[0] <= rates[-1] < 1
    slope, shift = platt(z, y)
    assert slope > 0 and sigmoid(np.array(slope * 0.4 + shift)) > sigmoid(np.array(shift))
    assert platt(z, np.ones(6))[0] == 0.0


def accuracy(rows, labels, label, column):
    truth = {r.doc_id: r[label] for r in labels.collect() if r.doc_id is not None and r[label] is not None}
    found = [(truth[r.doc_id], r[column]) for r in rows if r.doc_id in truth and r.doc_id < 240]
    return sum(int(t) == int(p) for t, p in found) / len(found)


def test_quality_rules(spark, labelled, empty_docs):
    docs, labels = labelled
    model = quality_rules.fit(docs, labels)
    rows = quality_rules.quality_rules(docs, model).collect()
    assert len(rows) == docs.count()
    learned = [r.asDict() | {"good": r.probability >= 0.3} for r in rows]
    truth = {r.doc_id: r.quality for r in labels.collect() if r.doc_id is not None}
    known = [r for r in learned if r["doc_id"] is not None and r["doc_id"] < 240 and r["doc_id"] != 5]
    assert np.mean([int(r["good"]) == truth[r["doc_id"]] for r in known]) > 0.95
    for r in rows:
        if r.text is None or len(r.text) < 10_000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counters(r.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.probability >= 0.3)
    assert quality_rules.quality_rules(empty_docs, model).count() == 0


@pytest.mark.parametrize(
    ("module", "apply", "label"),
    [(compression, compression.compression_quality, "quality"), (toxicity, toxicity.toxicity, "toxic")],
)
def test_scores(labelled, empty_docs, module, apply, label):
    docs, labels = labelled
    model = module.fit(docs, labels)
    out = apply(docs, model)
    rows = out.collect()
    assert len(rows) == docs.count() and [c.lower() for c in out.columns].count("score") == 1
    assert accuracy(rows, labels, label, "predicted") > 0.95
    limit = 0.3 if label == "quality" else 0.5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= limit) for r in rows)
    for a, b in odd_rows(rows):
        assert a.score == b.score
    nothing = {r.doc_id: r.score for r in rows if r.doc_id in (1000, 1001)}
    assert nothing[1000] == nothing[1001]
    assert apply(empty_docs, model).count() == 0
    again = {(r.doc_id, r.text): r.score for r in apply(docs, model).collect()}
    assert all(again[r.doc_id, r.text] == r.score for r in rows)


@pytest.mark.parametrize("module", [compression, toxicity, quality_rules])
def test_without_labels(spark, labelled, empty_docs, module):
    docs, labels = labelled
    model = module.fit(empty_docs, labels.where("doc_id < 0"))
    apply = {
        compression: compression.compression_quality,
        toxicity: toxicity.toxicity,
        quality_rules: quality_rules.quality_rules,
    }[module]
    assert apply(docs, model).count() == docs.count()


def test_held_out_labels_are_not_learned(spark, labelled):
    """Turning the labels of fold 0 around changes no score."""
    docs, labels = labelled
    turned = [
        (r.doc_id, r.quality if fold_of(r.doc_id) else 1 - (r.quality or 0), r.toxic) for r in labels.collect()
    ]
    other = spark.createDataFrame(turned, labels.schema)
    a = compression.compression_quality(docs, compression.fit(docs, labels)).collect()
    b = compression.compression_quality(docs, compression.fit(docs, other)).collect()
    assert sorted((str(r.doc_id), r.score) for r in a) == sorted((str(r.doc_id), r.score) for r in b)
