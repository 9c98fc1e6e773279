"""Toxicity: linear character n-gram classifier scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardhouse.llm.common import append_columns, labelled_sample, written
from wardhouse.llm.linear import char_ngrams, distinct, fit_sparse, platt, sigmoid
from wardhouse.llm.token_ids import forget_encoder

BITS = 20
ORDERS = (3, 4, 5, 6)
#: Labelled ids of each class that the classifier is fitted on, at most.
PER_CLASS = 4000
#: Labelled ids of fold 1 that the probability is calibrated on, at most.
CALIBRATE = 8000
#: N-gram buckets that the classifier uses.
FEATURES = 2048
RIDGE = 1e-3
TOXIC_FROM = 0.5


@dataclass(frozen=True)
class ToxicityModel:
    buckets: np.ndarray
    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def scorer(self):
        """A function from a list of texts to their probabilities."""
        forget_encoder()
        place = np.full(1 << BITS, -1, np.int16)
        place[self.buckets] = np.arange(len(self.buckets))

        def score(texts: list) -> list[float]:
            z = [float(self.weights[present(t or "", place)].sum()) + self.offset for t in texts]
            return sigmoid(self.slope * np.array(z) + self.shift).tolist()

        return score


def present(text: str, place: np.ndarray) -> np.ndarray:
    """The chosen features of a text, each once, in rising order."""
    found = place[char_ngrams(text, ORDERS, BITS)]
    return np.unique(found[found >= 0])


def _document_counts(sample: DataFrame) -> DataFrame:
    """(bucket, n0, n1): documents of each class that hold a bucket.

    A task adds up its rows in two arrays of 2**BITS numbers and gives what is
    not zero, so a row is shuffled for each task and bucket at most.
    """

    def run(batches):
        forget_encoder()
        counts = np.zeros((2, 1 << BITS), np.int32)
        scratch = np.zeros(1 << BITS, np.int32)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                counts[label][distinct(char_ngrams(text, ORDERS, BITS), scratch)] += 1
        import pandas as pd

        held = np.flatnonzero(counts.sum(0))
        for at in range(0, len(held), 100_000):
            part = held[at : at + 100_000]
            yield pd.DataFrame({"bucket": part, "n0": counts[0][part], "n1": counts[1][part]})

    parts = sample.select("text", "label").mapInPandas(run, "bucket int, n0 long, n1 long")
    return parts.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled ids of each class, calibrate on CALIBRATE others.

    r = log of the ratio of smoothed document counts in toxic and other texts;
    the FEATURES buckets with the surest r are kept, and a logistic regression
    is fitted on their presence times r (folds 2 to 4). Fold 1 calibrates it.
    The driver gets the chosen buckets and their places in the sampled texts.
    Without labelled rows of both classes every score is the smoothed rate.
    """
    sample = written(
        labelled_sample(docs, labels, "toxic", per_class, CALIBRATE, id_col, text_col), "toxic-sample"
    )
    total = [0, 0]
    for row in sample.where("fold > 1").groupBy("label").count().collect():
        total[row.label] = row["count"]
    p = (F.col("n1") + 1) / F.lit(total[1] + 2.0)
    q = (F.col("n0") + 1) / F.lit(total[0] + 2.0)
    ratio = F.log(p / q)
    chosen = (
        _document_counts(sample.where("fold > 1"))
        .withColumn("r", ratio)
        .withColumn("sure", F.abs("r") / F.sqrt(1 / (F.col("n1") + 1) + 1 / (F.col("n0") + 1)))
        .orderBy(F.desc("sure"), "bucket")
        .limit(FEATURES)
        .select("bucket", "r")
        .toPandas()
        .sort_values("bucket")
    )
    buckets, scale = chosen.bucket.to_numpy(np.int64), chosen.r.to_numpy(float)

    def make():
        forget_encoder()
        place = np.full(1 << BITS, -1, np.int16)
        place[buckets] = np.arange(len(buckets))

        def compute(texts: list) -> list:
            return [[present(t, place).astype(np.int16).tobytes() for t in texts]]

        return compute

    rows = (
        append_columns(sample, "text", [T.StructField("x", T.BinaryType())], make)
        .select("id", "label", "fold", "x")
        .limit(2 * (2 * per_class + CALIBRATE))
        .toPandas()
        .sort_values(["id", "x"])
    )
    x = [np.frombuffer(b, np.int16).astype(np.int64) for b in rows.x]
    y, train = rows.label.to_numpy(float), rows.fold.to_numpy() > 1
    weights, offset = fit_sparse([r for r, t in zip(x, train, strict=True) if t], y[train], scale, RIDGE)
    use = ~train if (~train).any() else train
    z = np.array([weights[r].sum() + offset for r, u in zip(x, use, strict=True) if u])
    slope, shift = platt(z, y[use])
    return ToxicityModel(buckets, weights, offset, slope, shift)


def toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """Adds score (0 to 1, higher: more likely toxic) and predicted (1 from TOXIC_FROM on).

    Every whole text is read. A null or empty text has the score of a text
    without any of the features. Columns named score or predicted are
    replaced; repeated rows are scored each by itself; an empty table gives an
    empty result.
    """
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def make():
        score = model.scorer()

        def compute(texts: list) -> list:
            scores = score(texts)
            return [scores, [int(s >= TOXIC_FROM) for s in scores]]

        return compute

    return append_columns(docs, text_col, fields, make)
