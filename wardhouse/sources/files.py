"""The few file-system calls that no DataFrame operation covers."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none if it does not exist."""
    fs, jvm_path = _fs(spark, path)
    if not fs.exists(jvm_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jvm_path) if s.isDirectory())


def child_files(spark: SparkSession, path: str, ending: str) -> list[str]:
    """Names of the files directly below a path that end so."""
    fs, jvm_path = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jvm_path) if s.getPath().getName().endswith(ending))


def folder_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the files below a path: another state after files were added."""
    fs, jvm_path = _fs(spark, path)
    summary = fs.getContentSummary(jvm_path)
    return summary.getFileCount(), summary.getLength()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path; none if it does not exist."""
    return folder_state(spark, path)[1] if has_file(spark, path) else 0


def has_file(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _fs(spark, path)
    return fs.exists(jvm_path)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Put the files that one write left in a folder in place of those of another folder.

    Files are moved one by one, after those of other writes are gone. If that is cut
    short, it is done again with what is left: nothing goes before its successor is
    complete in one of the two folders.
    """
    names = child_files(spark, source, ".parquet")
    if not names:
        return
    write = _write_of(names[0])
    fs, into = _fs(spark, target)
    fs.mkdirs(into)
    for name in child_files(spark, target, ".parquet"):
        if _write_of(name) != write:
            fs.delete(_fs(spark, f"{target}/{name}")[1], False)
    for name in names:
        moved, place = _fs(spark, f"{source}/{name}")[1], _fs(spark, f"{target}/{name}")[1]
        # A copy that was cut short, in a store that moves by copying.
        fs.delete(place, False)
        if not fs.rename(moved, place):
            raise OSError(f"{source}/{name} was not moved to {target}")


def _write_of(name: str) -> str:
    """The id that the names of all files of one write share: part-00000-<id>.c000..."""
    return name.split("-", 2)[2].split(".")[0]


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _fs(spark, path)
    fs.delete(jvm_path, True)
