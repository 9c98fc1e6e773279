import pytest

from llm_cases import BAD, GOOD, RUDE, mixed

from wardhouse.llm.token_ids import tokenizer_path

@pytest.fixture(scope="session")
def bpe():
    return tokenizer_path()


@pytest.fixture(scope="session")
def labelled(spark):
    """(documents, labels): 240 labelled texts, and odd rows without a label."""
    docs, labels = [], []
    for k in range(240):
        good, toxic = k % 3 != 0, k % 4 == 1
        text = f"{GOOD} {mixed(30, k)}" if good else f"{BAD} {mixed(10, k)}"
        if toxic:
            text += f" {RUDE} {mixed(5, k + 1000)}"
        docs.append((k, text, "en", "s", "clash"))
        labels.append((k, int(good), int(toxic)))
    docs += [
        (None, "a text without an id", "en", "s", "x"),
        (1000, None, "en", "s", "x"),
        (1001, "", None, None, None),
        (1002, " \n\t ", "en", "s", "x"),
        (1003, GOOD, "en", "s", "x"),
        (1003, GOOD, "en", "s", "x"),
        (1004, f"{GOOD} \n" * 30_000, "en", "s", "x"),
    ]
    labels += [(None, 1, 1), (5, None, None), (7, 1, 0), (99_999, 0, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, Score string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
