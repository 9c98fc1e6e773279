"""Daily batches of delimited text: layout, scan, and header contract."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardhouse.contracts import FOLDER_PREFIX, SEPARATOR, TABLES, Table, table
from wardhouse.session import work_path


def parse_batch_date(text: str) -> date:
    """A batch date written YYYY-MM-DD; anything else raises ``ValueError``."""
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError:
        raise ValueError(f"batch date must be YYYY-MM-DD, got {text!r}") from None


def batch_folder(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{FOLDER_PREFIX}{day:%Y%m%d}"


def batch_file(root: str, day: date, name: str) -> str:
    """Path of one table's extract: a file, or a folder of shards under that name."""
    return f"{batch_folder(root, day)}/{name}_{day:%Y%m%d}.txt"


def batch_glob(root: str, name: str) -> str:
    """All extracts of one table, every day."""
    return f"{root.rstrip('/')}/{FOLDER_PREFIX}*/{name}_*.txt"


def batch_date_of(path: Column) -> Column:
    """Batch date in the path of an extract, or of a shard of one."""
    return F.to_date(F.regexp_extract(path, r"_(\d{8})\.txt", 1), "yyyyMMdd")


def text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CSV_OPTIONS = {
    "sep": SEPARATOR,
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    # Every file's own header is compared with the schema; by default only the
    # first file's is read and the others are trusted.
    "enforceSchema": "false",
}


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of an extract, read from its first line only."""
    try:
        return spark.read.options(**CSV_OPTIONS).csv(path).columns
    except AnalysisException as error:
        if _missing(error):
            raise FileNotFoundError(f"batch file not found: {path}") from None
        raise


#: Lines of a split that one task puts in order at once, at most.
CHUNK = 1 << 15


def _quotes() -> Column:
    return F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))


def has_multiline_records(spark: SparkSession, path: str) -> bool:
    """Whether some line leaves a quote open, so that a record spans lines."""
    quoted = spark.read.text(path).filter(F.contains("value", F.lit('"')))
    return not quoted.filter(_quotes() % 2 == 1).isEmpty()


def read_text_table(
    spark: SparkSession, path: str, multiline: bool | None = None
) -> DataFrame:
    """All columns of an extract as text, by header name.

    Files are read in splits by many tasks. With ``multiline`` left open one pass
    over the raw lines decides whether records may span lines; if they do, they
    are put together from the lines of the splits, see :func:`text_records`.
    """
    names = read_header(spark, path)
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    if multiline is None:
        multiline = has_multiline_records(spark, path)
    schema = text_schema(names)
    if not multiline:
        return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    options = {k: CSV_OPTIONS[k] for k in ("sep", "quote", "escape")} | {"multiLine": "true"}
    rows = text_records(spark, path).select(F.from_csv("value", schema.simpleString(), options).alias("r"))
    return rows.select("r.*")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with their file, the start of their split, their place in it, and whether they
    hold an odd number of quotes."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        (_quotes() % 2).alias("odd"),
    )


def split_states(lines: DataFrame) -> DataFrame:
    """For each split: how many of its lines have an odd number of quotes, whether it begins
    inside a record (``inside``) and the line that opened it (``opened``), and its first line.

    A prefix sum over the splits of each file, one row a split. The line that opens a
    record is told by its split and the number of odd lines before it there.
    """
    # A list, which stays empty, lets Spark hold the text of min_by in objects; it sorts all lines
    # by their split otherwise.
    none = F.size(F.collect_list(F.when(F.col("odd") < 0, 1))) == 0
    splits = lines.groupBy("file", "block").agg(
        F.sum("odd").alias("n_odd"), F.when(none, F.min_by("value", "place")).alias("first_line")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_odd = F.when(F.col("n_odd") > 0, F.struct("block", (F.col("n_odd") - 1).alias("n")))
    return splits.withColumns(
        {
            "inside": F.coalesce(F.sum("n_odd").over(before), F.lit(0)) % 2,
            "opened": F.last(last_odd, ignorenulls=True).over(before),
        }
    )


def text_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of delimited text (``value``), without the header, in parallel over splits.

    A line is a record of its own where the quotes before it in its file are even and
    its own are too. Splits that hold no odd line and begin outside a record, normally
    nearly all, are taken as they are. The lines of the others are written once, numbered
    by split and in chunks of :data:`CHUNK` lines: prefix sums, one row a chunk and then
    one chunk at a time, find the record that each line belongs to, and only lines of
    records over several lines are grouped. No task sorts a whole split. All files must
    begin with the same header line. A quote that is never closed makes the rest of its
    file one record, as for any reader.
    """
    lines = _lines(spark, path)
    found = work_path(spark, "splits")
    split_states(lines).withColumn("split", F.monotonically_increasing_id()).write.parquet(found)
    splits = spark.read.parquet(found)
    headers = (
        splits.filter("block = 0").select(_bare("first_line").alias("header")).distinct().limit(2).collect()
    )
    if len(headers) > 1:
        raise ValueError(f"extracts below {path} begin with different header lines")
    header = headers[0]["header"] if headers else None
    marked = splits.filter("n_odd > 0 OR inside = 1").select("file", "block", "split")
    lines = lines.filter(~((F.col("block") == 0) & (_bare("value") == F.lit(header))))
    plain = lines.join(marked, ["file", "block"], "left_anti").select("value")
    single, joined = _grouped(spark, lines.join(marked, ["file", "block"]), splits)
    ones = plain.unionAll(single).filter(F.trim(F.translate("value", "\r\t", "  ")) != "")
    return ones.unionAll(joined).select(F.regexp_replace("value", r"\r\z", "").alias("value"))


def _grouped(spark: SparkSession, lines: DataFrame, splits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of lines with their split: those that are records, and the records over several lines."""
    held, sums = work_path(spark, "lines"), work_path(spark, "chunks")
    chunk = F.floor(F.col("place") / CHUNK).alias("chunk")
    lines.select("split", chunk, "place", "odd", "value").write.parquet(held)
    lines = spark.read.parquet(held)

    # The split and place of the line that a split begins inside of, and the odd lines before a chunk.
    openers = splits.select("file", F.col("block").alias("_block"), F.col("split").alias("opener"))
    begun = splits.join(
        openers, (splits["file"] == openers["file"]) & (F.col("opened.block") == F.col("_block")), "left"
    ).select("split", "inside", "opener", F.col("opened.n").alias("opener_n"))
    earlier = Window.partitionBy("split").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = lines.groupBy("split", "chunk").agg(F.sum("odd").alias("n_odd"))
    chunks = chunks.withColumn("before", F.coalesce(F.sum("n_odd").over(earlier), F.lit(0)))
    chunks.join(begun, "split").drop("n_odd").write.parquet(sums)

    order = Window.partitionBy("split", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("run", F.coalesce(F.sum("odd").over(order), F.lit(0)))
    placed = placed.join(spark.read.parquet(sums), ["split", "chunk"])
    run = F.col("before") + F.col("run")
    placed = placed.withColumns({"run": run, "within": (F.col("inside") + run) % 2})
    own = F.when(F.col("within") == 0, F.col("run")).when(F.col("run") > 0, F.col("run") - 1)
    opener = F.struct(F.col("opener").alias("split"), F.col("opener_n").alias("n"))
    placed = placed.withColumn(
        "start", F.when(own.isNotNull(), F.struct("split", own.alias("n"))).otherwise(opener)
    )
    alone = (F.col("within") == 0) & (F.col("odd") == 0)
    # Splits of a file are put in order by their start there.
    several = placed.filter(~alone).join(splits.select("split", "block"), "split")
    joined = (
        several.groupBy("start")
        .agg(F.array_sort(F.collect_list(F.struct("block", "place", "value"))).alias("lines"))
        .select(F.array_join(F.col("lines.value"), "\n").alias("value"))
    )
    return placed.filter(alone).select("value"), joined


def _bare(column: str) -> Column:
    """A line without byte-order mark and carriage return."""
    return F.regexp_replace(column, r"^\ufeff|\r\z", "")


def read_batch(
    spark: SparkSession, root: str, day: date, name: str, multiline: bool | None = None
) -> DataFrame:
    """Rows of one table in one daily batch; ``FileNotFoundError`` if absent."""
    return read_text_table(spark, batch_file(root, day, name), multiline)


def summarise(raw: DataFrame, contract: Table, day: date) -> DataFrame:
    """One row: rows read, contract columns missing, columns not in the contract.

    Column order does not matter, letter case does. An extract without rows
    counts as having no columns.
    """
    expected, actual = set(contract.header), set(raw.columns)
    missing, extra = sorted(expected - actual), sorted(actual - expected)

    def names(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    empty = F.col("row_count") == 0
    return (
        raw.agg(F.count("*").alias("row_count"))
        .select(
            F.lit(day).alias("batch_dt"),
            F.lit(contract.name).alias("src_table"),
            "row_count",
            F.when(empty, names(sorted(expected))).otherwise(names(missing))
            .alias("missing_columns"),
            F.when(empty, names([])).otherwise(names(extra)).alias("extra_columns"),
        )
        .withColumn(
            "is_valid", (F.size("missing_columns") == 0) & (F.size("extra_columns") == 0)
        )
    )


def validate_batch(spark: SparkSession, root: str, day: date, name: str) -> DataFrame:
    """Contract summary of one table; ``ValueError`` for a table without a contract."""
    contract = table(name)
    return summarise(read_batch(spark, root, day, contract.name), contract, day)


def validate_all_tables(spark: SparkSession, root: str, day: date) -> DataFrame:
    """Summaries of all tables of a batch, numbered in contract order."""
    out = None
    for position, contract in enumerate(TABLES.values(), start=1):
        one = validate_batch(spark, root, day, contract.name).withColumn("position", F.lit(position))
        out = one if out is None else out.unionByName(one)
    return out


def passed(summaries: DataFrame) -> DataFrame:
    """How many tables of a batch conform."""
    return summaries.groupBy("batch_dt").agg(
        F.count_if("is_valid").alias("n_valid"), F.count("*").alias("n_tables")
    )


def require_contract(raw: DataFrame, contract: Table, day: date) -> None:
    """Refuse an extract whose columns differ from the contract, or without rows."""
    missing = sorted(set(contract.header) - set(raw.columns))
    extra = sorted(set(raw.columns) - set(contract.header))
    if not missing and not extra and raw.isEmpty():
        missing = sorted(contract.header)
    if missing or extra:
        raise ValueError(
            f"invalid extract {contract.name} of {day}: missing={missing} extra={extra}"
        )
