"""Small intermediate tables, written to the cluster's shared checkpoint folder.

An intermediate result that is read more than once, or whose size decides the join strategy, is
written out and read back. That cuts its lineage, survives the loss of executors, and lets the
planner see its true size: a join with a staged table is broadcast only when its files are smaller
than spark.sql.autoBroadcastJoinThreshold and is shuffled (with skew splitting) otherwise.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# A session without executors of their own; there any folder is shared.
_ONE_PROCESS = re.compile(r"local(\[[^\]]*\])?$")

_own_folders: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)
_lock = threading.Lock()


def staging_root(spark: SparkSession) -> str:
    """This application's folder under spark.checkpoint.dir.

    A session in one process may leave the setting out and gets a folder of its own; any other
    session has to name a folder that all executors share.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not _ONE_PROCESS.match(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        with _lock:
            if context.applicationId not in _own_folders:
                _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="plumbrow-")
            folder = _own_folders[context.applicationId]
    return f"{folder}/plumbrow-{context.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path of its own for a table, deleted with the scope it was made in."""
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles deleted that no plan needs any more, be it on other machines.

    Spark does so when the driver collects its garbage, which one with memory to spare rarely does. Meanwhile the
    files of whatever was shuffled lie beside those of what is shuffled next. To be called after large results
    were staged; it takes a fraction of a second.
    """
    spark.range(1, numPartitions=1).collect()  # the scheduler holds on to its last job
    spark._jvm.System.gc()


@contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[None]:
    """Deletes what is staged inside, once the results that need it have been written.

    Threads started inside belong to it if they run functions wrapped by `in_same_scope`.
    """
    scope: list[str] = []
    outer = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in scope:
            delete_path(spark, path)


def in_same_scope(function: Callable) -> Callable:
    scope = _scope.get()

    def run(*args):
        outer = _scope.set(scope)
        try:
            return function(*args)
        finally:
            _scope.reset(outer)

    return run


def drop_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables; frames built on them can no longer be run."""
    delete_path(spark, staging_root(spark))


def delete_path(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
