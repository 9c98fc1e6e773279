"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that the caller
writes as Parquet and rereads as the next stage's docs. All but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardhouse.llm import compression, neardup, packing, pii, toxicity
from wardhouse.llm.common import table, written
from wardhouse.llm.token_ids import tokenizer_path

#: Words of a shingle and least similarity, in percent, of near-duplicates.
SHINGLE, SIMILAR = 5, 80
#: The key of the surrogates; a real run takes its own from a secret store.
PII_KEY = "fixed key of the registered pipeline"
#: Up to so many ids of dropped copies (8 bytes each) are broadcast; more are joined by shuffle.
FEW_IDS = 1_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on the labelled rows of the whole table, does
    not reject.

    A null or empty text holds nothing toxic and stays. Repeated rows are judged
    alike; an empty table stays empty; columns named score or predicted, which
    the classifier uses, come back as they were.
    """
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return _judged(docs, lambda d: toxicity.toxicity(d, model), "predicted = 0")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier finds good enough; nulls, repeats and clashing
    columns as in the stage before."""
    model = compression.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return _judged(docs, lambda d: compression.compression_quality(d, model), "predicted = 1")


def _judged(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], kept: str) -> DataFrame:
    """The rows a classifier keeps; their columns go by it under other names."""
    own = [f"c{k}" for k in range(len(docs.columns))]
    text = own[docs.columns.index("text")]
    renamed = docs.toDF(*own).withColumnRenamed(text, "text")
    names = ["text" if c == text else c for c in own]
    return judge(renamed).where(kept).select(*names).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, the one of the smallest id.

    Texts without words are in no group and stay. Where ids are null or repeat,
    rows are numbered first, so that still exactly one row of a group stays.
    """
    rows, ids = docs.agg(F.count("*"), F.count_distinct("doc_id")).first()
    key = "doc_id"
    if rows != ids:
        key = "__row"
        docs = written(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    found = neardup.near_duplicates(docs, size=SHINGLE, percent=SIMILAR, id_col=key)
    gone = written(found.where(~F.col("kept")).select(F.col("doc_id").alias(key)), "copies")
    few = gone.count() <= FEW_IDS
    out = docs.join(F.broadcast(gone) if few else gone, key, "left_anti")
    return out.drop("__row")


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars follows the new text."""
    columns = docs.columns
    out = pii.replace_pii(docs, key=PII_KEY, count_col="__entities").drop("__entities")
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences."""
    return packing.packed_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_classifier", keep_good),
    ("near_dedup", drop_near_duplicates),
    ("pii", replace_pii),
    ("packing", pack),
]

#: The classifiers, the tokenizer and the packing have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
