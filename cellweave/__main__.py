"""``python -m cellweave``: preprocess, count, count_matrix and simulate_reads on the session's cluster."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellweave.jobs import count as jobs
from cellweave.operators.extract import read_config
from cellweave.session import prepare
from cellweave.sources import fastq, simulate


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cellweave", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("preprocess", help="take barcodes off the reads of a folder")
    one.add_argument("fastq_dir")
    one.add_argument("--config", required=True)
    one.add_argument("--output-dir", default=".")
    one = commands.add_parser("count", help="take barcodes off reads, tag their alignments, correct UMIs and count")
    one.add_argument("fastq_dir")
    one.add_argument("--config", required=True)
    one.add_argument("--preprocessed", help="where preprocess wrote, if it has run")
    one.add_argument("--alignments", required=True, action="append", help="BAM, SAM or Parquet; one of each pair of files in order, or any number for all")
    one.add_argument("--output-dir", default=".")
    one = commands.add_parser("count_matrix", help="count tagged alignments")
    one.add_argument("alignments", nargs="+")
    one.add_argument("--output-dir", default=".")
    one = commands.add_parser("simulate_reads", help="reads with known barcodes")
    one.add_argument("--config", required=True)
    one.add_argument("--fastq-prefix", required=True, help="FOLDER/NAME: read files FOLDER/name=NAME_1 and, with barcodes in both mates, FOLDER/name=NAME_2")
    one.add_argument("--nreads", type=int, required=True)
    one.add_argument("--unique-umis", type=float, default=0.5)
    one.add_argument("--seed", type=int, default=42)
    one.add_argument("--error-probability", type=float, default=0.1)
    one.add_argument("--substitution-probability", type=float, default=0.7)
    one.add_argument("--insertion-probability", type=float, default=0.5)
    return parser


def run(spark: SparkSession, given: list[str] | None = None) -> None:
    args = arguments().parse_args(given)
    prepare(spark)
    if args.command == "preprocess":
        jobs.preprocess(spark, args.fastq_dir, read_config(args.config), args.output_dir)
    elif args.command == "count":
        jobs.count_reads(spark, args.fastq_dir, read_config(args.config), args.alignments, args.output_dir, args.preprocessed)
    elif args.command == "count_matrix":
        jobs.matrices(jobs.load_alignments(spark, args.alignments), args.output_dir)
    else:
        config = read_config(args.config)
        structs = [config["barcode_struct_r1"], *([config["barcode_struct_r2"]] if jobs.both_barcoded(config) else [])]
        reads = simulate.simulated(
            spark, structs, args.nreads, bool(config["unknown_read_orientation"]), args.unique_umis, args.seed,
            args.error_probability, args.substitution_probability, args.insertion_probability,
        )
        folder, _, name = args.fastq_prefix.rpartition("/")
        fastq.write(reads.withColumn("name", F.concat(F.lit(f"{name}_"), F.col("mate").cast("string"))), folder or ".")


if __name__ == "__main__":
    run(SparkSession.builder.getOrCreate())
