"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wardhouse.session import work_path

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: The most text bytes handled at once inside a task.
SLICE_BYTES = 8_000_000


def give_back_memory() -> None:
    """Return to the system what earlier tasks of this Python worker used and freed.

    A worker serves one task after the other; what its allocators hold counts for the
    executor while the next operator works.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc only
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame without the columns an operator is about to write (case does not count)."""
    gone = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that its lineage ends there."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in fold 0."""
    value = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    return F.coalesce(value, F.lit(0)).cast("int")


def slices(batches: Iterator[pa.RecordBatch], text_col: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of a piece stay within ``most`` bytes.

    A single longer text is a piece of its own.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_col))
        begin, size = 0, 0
        for row, length in enumerate(pa.compute.binary_length(column).to_pylist()):
            if size and size + (length or 0) > most:
                yield batch.slice(begin, row - begin)
                begin, size = row, 0
            size += length or 0
        if begin < batch.num_rows:
            yield batch.slice(begin)


def append_columns(
    df: DataFrame,
    text_col: str,
    fields: list[T.StructField],
    make: Callable[[], Callable[[list], list]],
) -> DataFrame:
    """Append columns computed from whole texts, in Arrow batches.

    ``make`` is called once in each task and gives the function that turns a
    list of texts (null: None) into one list of values for each field. Columns
    of the input with the name of a new field are replaced.
    """
    import pyarrow.compute  # noqa: F401 - the executors need it loaded

    kept = without(df, [f.name for f in fields if f.name.lower() != text_col.lower()])
    names = [c for c in kept.columns if c not in {f.name for f in fields}]
    schema = T.StructType([kept.schema[c] for c in names] + fields)
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        compute = make()
        for piece in slices(batches, text_col):
            texts = piece.column(piece.schema.get_field_index(text_col)).to_pylist()
            new = [pa.array(v, k) for v, k in zip(compute(texts), kinds, strict=True)]
            old = [piece.column(piece.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                old + new, schema=pa.schema(
                    [piece.schema.field(c) for c in names]
                    + [pa.field(f.name, k) for f, k in zip(fields, kinds, strict=True)]
                )
            )

    return kept.mapInArrow(run, schema)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    per_class: int,
    calibrate: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, text, label, fold): the rows a classifier is fitted on.

    At most ``per_class`` labelled ids of each class from folds 2 to 4, to train
    on, and at most ``calibrate`` from fold 1, whatever their class, so that
    they show the classes' true shares. Fold 0 is never used. Which ids are
    taken depends on a hash of the id alone. An id labelled more than once has
    the label of most of its rows, the larger at a tie. The chosen ids, a
    bounded number, go through the driver; the texts do not.
    """
    spark = docs.sparkSession
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .groupBy("id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .withColumn("fold", fold("id"))
    )
    ids: list[tuple] = []
    for group, most in (
        ("fold > 1 and label = 0", per_class),
        ("fold > 1 and label = 1", per_class),
        ("fold = 1", calibrate),
    ):
        chosen = known.where(group).orderBy(F.xxhash64("id"), "id").limit(most)
        ids += [tuple(r) for r in chosen.collect()]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(spark.createDataFrame(ids, known.schema)), "id")
