"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

1. quality classifier: documents scored under 0.3 go;
2. quality rules: documents that the weighed rules reject go;
3. near-duplicates: the document with the smallest id of each group stays;
4. secrets: every document stays, its secrets masked, live ones and copied examples under marks of their own;
5. packing: the pieces of what is left and their places in sequences of 2048 tokens.

SQL cannot express the trained stages, so there is no SQL for the whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import neardup, packing, quality, rules, secrets
from cellweave.session import prepare, written

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality.keep_good),
    ("quality_rules", rules.keep_good),
    ("near_duplicates", neardup.keep_one),
    ("secrets", secrets.mask_secrets),
    ("packing", packing.packed_stage),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents in ``sf_dir``; an empty table gives an empty result."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
