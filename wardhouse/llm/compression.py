"""Quality classifier: sizes under zstandard dictionaries of good and of bad text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardhouse.llm.common import append_columns, labelled_sample, written
from wardhouse.llm.linear import isotonic

#: Labelled ids of each class that the dictionaries are built from, at most.
PER_CLASS = 2500
#: Labelled ids of fold 1 that the curve is fitted on, at most.
CALIBRATE = 8000
#: Blocks of each class that a dictionary is built from, at most.
SAMPLES = 3000
#: Texts are compressed in blocks of so many bytes, so that a long text does not
#: become its own dictionary.
BLOCK = 2048
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Added to a text's length when the size difference is normalised.
SMOOTH = 128
GOOD_FROM = 0.3


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    knots: tuple[float, ...]
    rates: tuple[float, ...]

    def measure(self):
        """A function from a text to its normalised difference in compressed size."""
        presses = [_compressor(d) for d in (self.good, self.bad)]

        def difference(text: str) -> float:
            raw = text.encode()
            small, large = (
                sum(len(p.compress(raw[at : at + BLOCK])) for at in range(0, len(raw), BLOCK))
                for p in presses
            )
            return (large - small) / (len(raw) + SMOOTH)

        return difference

    def scorer(self):
        """A function from a list of texts to their probabilities of good quality."""
        difference = self.measure()

        def score(texts: list) -> list[float]:
            d = [difference(t or "") for t in texts]
            return np.interp(d, self.knots, self.rates).tolist()

        return score


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_content_size": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **options)


def build_dictionary(blocks: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the blocks themselves where they are too few to train on."""
    if not blocks:
        return b""
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-size:]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> CompressionModel:
    """Build the dictionaries (folds 2 to 4) and the calibration curve (fold 1).

    The blocks of the sampled texts are ranked by a hash, and SAMPLES of each
    class come to the driver. The curve is the rising step curve of the label
    over the size difference; the driver gets one number for each text of fold
    1 of the sample. Without labelled rows every score is one half.
    """
    sample = written(
        labelled_sample(docs, labels, "quality", per_class, CALIBRATE, id_col, text_col), "quality-sample"
    )

    def cut(batches):
        import pandas as pd

        for batch in batches:
            for label, text in zip(batch["label"], batch["text"], strict=True):
                raw = text.encode()
                parts = [raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK)]
                yield pd.DataFrame({"label": [label] * len(parts), "block": parts})

    blocks = sample.where("fold > 1").select("label", "text").mapInPandas(cut, "label int, block binary")
    dictionaries = []
    for label in (1, 0):
        few = blocks.where(F.col("label") == label).orderBy(F.xxhash64("block"), "block").limit(SAMPLES)
        dictionaries.append(build_dictionary([bytes(r.block) for r in few.select("block").collect()]))
    model = CompressionModel(*dictionaries, (0.0,), (0.5,))

    def make():
        difference = model.measure()
        return lambda texts: [[difference(t) for t in texts]]

    curve = (
        append_columns(sample.where("fold = 1"), "text", [T.StructField("z", T.DoubleType())], make)
        .select("z", "label")
        .limit(2 * CALIBRATE)
        .toPandas()
    )
    knots, rates = isotonic(curve.z.to_numpy(), curve.label.to_numpy())
    return CompressionModel(*dictionaries, tuple(knots), tuple(rates))


def compression_quality(docs: DataFrame, model: CompressionModel, text_col: str = "text") -> DataFrame:
    """Adds score (0 to 1, higher: more likely good) and predicted (1 from GOOD_FROM on).

    Every whole text is read. A null or empty text has difference 0. Columns
    named score or predicted are replaced; repeated rows are scored each by
    itself; an empty table gives an empty result.
    """
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def make():
        score = model.scorer()

        def compute(texts: list) -> list:
            scores = score(texts)
            return [scores, [int(s >= GOOD_FROM) for s in scores]]

        return compute

    return append_columns(docs, text_col, fields, make)
