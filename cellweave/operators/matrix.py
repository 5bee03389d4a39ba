"""Read and UMI counts by feature and cell, from alignments.

Alignments have ``ref, cb, ub`` (or ``ur``), ``gx, gn`` and the pairing flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.sequences import features


def countable() -> Column:
    """Unpaired reads, first mates, and second mates whose mate is unmapped."""
    return ~F.col("is_paired") | F.col("is_read1") | (F.col("is_read2") & F.col("mate_is_unmapped"))


def exploded(alignments: DataFrame) -> DataFrame:
    """One row for each alignment and feature; alignments without features go."""
    return alignments.withColumn("feature", F.explode(features(F.col("gx"), F.col("gn")))).drop("gx", "gn").select("*", "feature.gx", "feature.gn").drop("feature")


def molecule_counts(alignments: DataFrame, umi: str = "ub") -> DataFrame:
    """Countable reads of each (ref, cb, gx, gn, UMI): what both matrices sum up."""
    rows = exploded(alignments.where(countable()).select("ref", "cb", umi, "gx", "gn"))
    return rows.groupBy("ref", "cb", "gx", "gn", umi).agg(F.count("*").alias("n"))


def read_matrix(alignments: DataFrame) -> DataFrame:
    """(gx, gn, cb, n_reads): countable reads, each toward all its features."""
    rows = exploded(alignments.where(countable()).select("cb", "gx", "gn"))
    return rows.groupBy("gx", "gn", "cb").agg(F.count("*").alias("n_reads"))


def umi_matrix(alignments: DataFrame, umi: str = "ub") -> DataFrame:
    """(gx, gn, cb, n_reads, n_umis); a UMI seen on two references counts twice."""
    counts = molecule_counts(alignments, umi)
    return counts.groupBy("gx", "gn", "cb").agg(F.sum("n").cast("long").alias("n_reads"), F.count("*").alias("n_umis"))


def axes(alignments: DataFrame) -> DataFrame:
    """(axis, label): all barcodes and features of all alignments, countable or not."""
    cells = alignments.select(F.lit("barcode").alias("axis"), F.col("cb").alias("label"))
    genes = exploded(alignments.select("gx", "gn")).select(F.lit("feature").alias("axis"), F.concat_ws("\t", "gx", "gn").alias("label"))
    return cells.unionByName(genes).distinct()
