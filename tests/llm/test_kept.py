"""A Python worker gives back what an encoding task left in it."""

import sys

import numpy as np

from wardhouse.llm import token_ids
from wardhouse.llm.toxicity import ToxicityModel


def test_a_classifier_task_drops_the_encoder_of_an_earlier_task():
    first = token_ids.encoder(token_ids.tokenizer_path())
    assert token_ids.encoder(token_ids.tokenizer_path()) is first
    score = ToxicityModel(np.array([3, 9]), np.array([1.0, -1.0]), 0.0, 1.0, 0.0).scorer()
    assert score(["a text"]) and "wardhouse_llm_kept" not in sys.modules
    assert token_ids.encoder(token_ids.tokenizer_path()) is not first


def test_packing_begins_by_giving_back_memory(spark, monkeypatch):
    from wardhouse.llm import common, packing

    assert packing.give_back_memory is common.give_back_memory
    common.give_back_memory()
    encode = token_ids.Encoder(token_ids.tokenizer_path())
    ids, counts = encode.encode_all(__import__("pyarrow").array(["a b c", "", "d\ne  f"]), 0)
    assert counts.dtype == np.int64 and counts.sum() == len(ids)
    assert encode.starts.dtype == encode.counts.dtype == np.int32
