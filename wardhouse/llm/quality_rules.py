"""Quality rules: text counters and a hashed n-gram classifier against fixed thresholds."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardhouse.llm.common import append_columns, labelled_sample
from wardhouse.llm.linear import char_ngrams, fit_dense, platt, sigmoid, word_ngrams

#: Buckets (as a power of two) of character and of word n-grams.
BITS = 12
CHAR_ORDERS = (1, 2, 3, 4)
#: Labelled ids of each class that the classifier is fitted on, at most.
PER_CLASS = 1500
#: Labelled ids of fold 1 that the probability is calibrated on, at most.
CALIBRATE = 1500
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document below this probability of good quality is not kept.
KEEP_FROM = 0.3

_SYMBOLS = "#*$%&|<>"
_BLANKS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_WINDOW = 5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def probability(self, features: np.ndarray) -> float:
        z = float(features @ self.weights) + self.offset
        return float(sigmoid(np.array(self.slope * z + self.shift)))


def features(text: str, words: list[bytes]) -> np.ndarray:
    """Square roots of the shares of each bucket, characters first, then words."""
    size = 1 << BITS
    out = np.zeros(2 * size, np.float32)
    for at, grams in (
        (0, char_ngrams(text, CHAR_ORDERS, BITS, lower=False)),
        (size, word_ngrams(words, BITS)),
    ):
        if len(grams):
            out[at : at + size] = np.sqrt(np.bincount(grams, minlength=size) / len(grams))
    return out


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found twice or more in the text."""
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(_WINDOW):
        mixed = (mixed ^ (mixed >> np.uint64(29))) + codes[k : k + n] * _ODD[k]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    maybe = order[np.append(same, False) | np.append(False, same)]
    if not len(maybe):
        return 0
    seen: dict[tuple, int] = {}
    for at in maybe.tolist():  # equal hashes are compared word by word
        window = tuple(words[at : at + _WINDOW])
        seen[window] = seen.get(window, 0) + 1
    cover = np.zeros(len(words) + 1, np.int64)
    for at in maybe.tolist():
        if seen[tuple(words[at : at + _WINDOW])] > 1:
            cover[at] += 1
            cover[at + _WINDOW] -= 1
    return int((np.cumsum(cover) > 0).sum())


def counters(text: str, raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(raw.count(c) for c in _BLANKS),
        sum(text.count(c) for c in _SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> QualityModel:
    """Fit on at most ``per_class`` labelled ids of each class, calibrate on CALIBRATE others.

    The n-grams are hashed on the executors; the driver gets one row of
    2 * 2**BITS half floats for each chosen document. Fold 1 calibrates the
    probability (a logistic curve), the others train. Without labelled rows
    every probability is one half.
    """
    sample = labelled_sample(docs, labels, "quality", per_class, CALIBRATE, id_col, text_col)

    def make():
        def compute(texts: list) -> list:
            return [[features(t, t.encode().split()).astype(np.float16).tobytes() for t in texts]]

        return compute

    rows = (
        append_columns(sample, "text", [T.StructField("x", T.BinaryType())], make)
        .select("id", "label", "fold", "x")
        .limit(2 * (2 * per_class + CALIBRATE))
        .toPandas()
        .sort_values(["id", "x"])
    )
    if not len(rows):
        return QualityModel(np.zeros(2 << BITS, np.float32), 0.0, 0.0, 0.0)
    x = np.empty((len(rows), 2 << BITS), np.float32)
    for k, raw in enumerate(rows.pop("x")):
        x[k] = np.frombuffer(raw, np.float16)
    y = rows.label.to_numpy(float)
    held = rows.fold.to_numpy() == 1
    weights, offset = fit_dense(x[~held], y[~held], 1e-5)
    use = held if held.any() else ~held
    slope, shift = platt(x[use] @ weights + offset, y[use])
    return QualityModel(weights.astype(np.float32), offset, slope, shift)


def quality_rules(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """Counters, base rules and the classifier's verdict for every whole text.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, probability and kept; a column of the input with one of these
    names is replaced. A null text counts as no words: all counters 0, base
    rules failed, not kept. Repeated rows are judged each by itself. An empty
    table gives an empty result.
    """
    fields = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("probability", T.DoubleType()), T.StructField("kept", T.BooleanType())]

    def make():
        def compute(texts: list) -> list:
            rows = []
            for text in texts:
                text = text or ""
                raw = text.encode()
                words = raw.split()
                counts = counters(text, raw, words)
                failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
                chance = model.probability(features(text, words))
                rows.append((*counts, failed, chance, not failed and chance >= KEEP_FROM))
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in fields]

        return compute

    return append_columns(docs, text_col, fields, make)
