"""Session facts the jobs rely on."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from wardhouse.sources.files import drop_folder


_T = TypeVar("_T")
# Jobs of independent tables that wait for the cluster at once.
_AT_ONCE = 4


def at_once(jobs: Sequence[Callable[[], _T]], width: int = _AT_ONCE) -> list[_T]:
    """The results of independent steps, in order, with the Spark jobs of some of them running
    side by side: a small one fills the cores that the last tasks of another leave idle.

    The first failure, by order, is raised when the steps that run have ended; those that
    have not begun are left out.
    """
    with ThreadPoolExecutor(max(1, min(width, len(jobs)))) as pool:
        local = inheritable_thread_target(SparkSession.getActiveSession())
        futures = [pool.submit(local(job)) for job in jobs]
        try:
            return [f.result() for f in futures]
        finally:
            pool.shutdown(wait=True, cancel_futures=True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: Counter = Counter()
_cleanup_before: dict = {}
_cleanup_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within this block the shuffle files of a query go when it ends. Otherwise they stay until the
    driver happens to collect its garbage, and those of one large step pile up on those of another.

    Several threads may be inside; the session's own setting is back when the last one leaves.
    """
    session = spark._jsparkSession.sessionUUID()
    with _cleanup_lock:
        if not _cleaning[session]:
            _cleanup_before[session] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _cleaning[session] += 1
    try:
        yield
    finally:
        with _cleanup_lock:
            _cleaning[session] -= 1
            if not _cleaning[session]:
                del _cleaning[session]
                before = _cleanup_before.pop(session)
                if before is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and work tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    (tests) may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="wardhouse-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def _work_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/work/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one work table of this application in the shared folder."""
    return f"{_work_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_work_tables(spark: SparkSession) -> None:
    """Delete this application's work tables, once nothing built on them is read again."""
    drop_folder(spark, _work_root(spark))
