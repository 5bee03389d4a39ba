"""Run a function over batches of texts on Spark, other columns passing through untouched."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import prepare
from cellweave.llm.textkit import chunks


def map_texts(
    df: DataFrame, text: str, fn: Callable[[list[str | None]], dict[str, Sequence]], schema: str,
    keep: Sequence[str] | None = None, limit: int = 1 << 20,
) -> DataFrame:
    """``keep`` columns of ``df`` (all, if None) and the columns that ``fn`` gives for each text.

    ``fn`` gets texts of about ``limit`` characters together. Columns of ``keep`` keep their
    types and nulls, since only Arrow arrays are handed on.
    """
    prepare(df.sparkSession)
    keep = list(df.columns) if keep is None else list(keep)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for low, high in chunks(texts, limit):
                made = fn(texts[low:high])
                columns = [batch.column(i).slice(low, high - low) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(made[n]) for n in names)], names=[*keep, *names])

    fields = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), schema])
    chosen = df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").cast("string").alias("_cw_text"))
    return chosen.mapInArrow(run, fields)
