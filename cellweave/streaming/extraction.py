"""Barcode extraction from a stream of reads, for runs that are still being sequenced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cellweave.operators.extract import Layout, extract


def extract_stream(reads: DataFrame, layout: Layout, threshold: float, out: str, checkpoint: str, either_strand: bool = False, available_now: bool = True) -> StreamingQuery:
    """Write decoded reads that score ``threshold`` or more to ``out/batch=<n>``.

    Extraction looks at one read at a time, so the stream has no state and needs no watermark;
    the threshold is given, from an earlier batch run. A batch that is repeated after a failure
    overwrites its own folder, so each read comes out once.
    """

    def one(batch: DataFrame, number: int) -> None:
        found = extract(batch, layout, either_strand).where((F.col("score") >= threshold) & F.col("end_pos").isNotNull())
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = reads.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
