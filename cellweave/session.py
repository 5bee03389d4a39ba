"""Session helpers that every job shares: the shared folder, written intermediates, worker imports."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)

#: Arrow batches are bounded by bytes as well as by rows, so that a run of long texts stays small.
ARROW_ROWS, ARROW_BYTES = "2000", str(16 << 20)


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package and bound the batches they receive."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a session without that setting (a local test) gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cellweave-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/cellweave/{name}-{uuid.uuid4().hex}"


#: Tables that each open :func:`run_scope` has written, innermost last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def _located(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def removed(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with what is in it, wherever Spark can; nothing there is no error."""
    store, place = _located(spark, path)
    store.delete(place, True)


def renamed(spark: SparkSession, path: str, to: str) -> None:
    store, place = _located(spark, path)
    if not store.rename(place, _located(spark, to)[1]):
        raise OSError(f"{path} could not be renamed {to}")


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediates of what runs inside once it has ended, well or not.

    What it gives has to be written elsewhere by then: a table that :func:`written` gave is gone.
    """
    own: list[str] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in own:
            removed(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage at a copy that survives lost executors, and lets several
    later jobs read one result without computing it again. Inside a :func:`run_scope` the
    copy goes when that ends; otherwise it stays.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if _scopes.get():
        _scopes.get()[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
