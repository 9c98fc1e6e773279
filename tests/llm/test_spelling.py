import random
import re
import zlib
from collections import Counter

import pytest

from wardhouse.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, root string"


def plain_counts(rows, slip, least_length=5, least_count=3):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if slip:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                if h % slip == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain_variants(counts, ratio=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v.encode()), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            forms[w] = best

    def root(w):
        while w in forms:
            w = forms[w]
        return w

    return sorted(
        (w, forms.get(w) or "", root(w), n, len(near[w]), counts.get(forms.get(w), -1)) for w, n in counts.items()
    )


def result(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def edited(word, rng):
    at, letter = rng.randrange(len(word)), rng.choice("abcdexyzéÿ")
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


def texts(seed=2, longest=60):
    rng = random.Random(seed)
    words = []
    for _ in range(40):
        base = "".join(rng.choice("abcde") for _ in range(rng.randrange(4, 12)))
        words += [base] * rng.randrange(1, 30)
        for _ in range(8):
            variant = edited(base, rng)
            words += [variant] * rng.randrange(1, 9)
            words += [edited(variant, rng)] * rng.randrange(1, 5)
    # Many words that share a chunk, down to all but one letter.
    words += [f"hello{a}{b}" for a in "abcdefgh" for b in "abcdefgh" for _ in range(3)]
    words += [f"{a}{b}world" for a in "abcdefgh" for b in "àáâã" for _ in range(4)]
    words += ["aaaaa"] * 9 + ["aaaaaa"] * 4 + ["aaaaaaa"] * 3 + ["z" * longest] * 8 + ["z" * (longest - 1)] * 3
    rng.shuffle(words)
    seps = [" ", "\n", "-", "¿", "ł", "\U0001f600", "9", "_"]
    rows = [
        (k, "".join(w + rng.choice(seps) for w in words[k * 60 : k * 60 + 60])) for k in range(len(words) // 60 + 1)
    ]
    rows += [(None, "HELLOab Écoleabc écoleabc"), (None, "Écoleabc Écoleabc"), (900, None), (901, "")]
    rows += [(902, "x " * 50_000 + "worlds"), (902, "x " * 50_000 + "worlds"), (903, "Worlds×worlds")]
    return rows


@pytest.mark.parametrize(("slip", "pairs", "longest"), [(97, 4096, 20_000), (3, 20, 60)])
def test_variants_by_brute_force(spark, monkeypatch, slip, pairs, longest):
    monkeypatch.setattr(spelling, "PAIRS", pairs)
    rows = texts(longest=longest)
    df = spark.createDataFrame([(k, t, "w", 1, "r") for k, t in rows], SCHEMA).repartition(3)
    counts = plain_counts(rows, slip)
    assert len(counts) > 200
    assert result(spelling.spelling_variants(df, slip=slip)) == plain_variants(counts)


def test_many_large_groups_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PAIRS", 10)
    monkeypatch.setattr(spelling, "FEW_KEYS", 0)
    rows = texts(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(spelling.spelling_variants(df, slip=5)) == plain_variants(plain_counts(rows, 5))


def test_tasks_give_counts_out_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 7)
    rows = texts(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.n for r in spelling.word_counts(df, 97).collect()}
    assert got == plain_counts(rows, 97)


def test_chains_lead_to_their_end(spark):
    words = ["aaaaaaaa"[:k] + "bbbbbbbb"[k:] for k in range(9)]
    rows = [(k, " ".join([w] * (3 * 2**k))) for k, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in spelling.spelling_variants(df).collect()}
    assert got[words[0]] == (words[1], words[8]) and got[words[8]] == (None, words[8])


def test_length_and_count_are_parameters(spark):
    rows = [(1, "ab ab abc"), (2, "abc abd")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spelling.spelling_variants(df, least_length=2, least_count=1)
    assert result(got) == plain_variants(plain_counts(rows, None, 2, 1))
    with pytest.raises(ValueError, match="circle"):
        spelling.spelling_variants(df, ratio=1)


def test_nothing(spark, empty_docs):
    assert spelling.spelling_variants(empty_docs).count() == 0
    df = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    out = spelling.spelling_variants(df)
    assert out.count() == 0 and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
