"""Whitelist files in, counter files out."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.session import prepare
from cellweave.sources.files import GZIP, located, opened


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """(barcode) of each line, without what follows its first ``-``. A file without lines is an error.

    Whether a file is gzipped its content tells. Spark reads and splits those whose name tells the
    same; others are read by one task.
    """
    store, name = located(path)
    with store.open_input_file(name) as f:
        zipped = f.read(2) == GZIP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column(0).to_pylist():
                with opened(one) as stream:
                    while lines := stream.readlines(1 << 20):
                        yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in lines], pa.string())], names=["value"])

    if zipped == path.endswith(".gz"):
        lines = spark.read.text(path)
    else:
        lines = prepare(spark).createDataFrame([(path,)], "value string").mapInArrow(run, "value string")
    found = lines.select(F.substring_index(F.trim(F.regexp_replace("value", r"[\r\n\t]", "")), "-", 1).alias("barcode"))
    if found.isEmpty():
        raise ValueError(f"no barcodes in {path}")
    return found


def counter_lines(counters: DataFrame) -> DataFrame:
    """(key, line): ``key: 1,234`` of (key, n)."""
    return counters.select("key", F.concat(F.col("key"), F.lit(": "), F.format_number("n", 0)).alias("line"))


def write_counters(counters: DataFrame, folder: str) -> None:
    """The counters' lines by key; an existing folder is an error."""
    counter_lines(counters).repartitionByRange("key").sortWithinPartitions("key").select(F.col("line").alias("value")).write.mode("errorifexists").text(folder)
