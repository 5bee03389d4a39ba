"""The whole way from read files and alignments to count matrices.

Aligning is another program's work: ``preprocess`` writes what it reads, ``count`` reads what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators import matrix, reads, umi
from cellweave.operators.extract import Layout, aligned, extract
from cellweave.session import run_scope, written
from cellweave.sources import alignments as sam
from cellweave.sources import fastq, files, lists, market
from cellweave.sources.output import MANIFEST, Output, part

#: Last record of the sample that tells which file holds the barcodes. Fixed value.
ORIENTATION_SAMPLE = 500
_KEY = ["file_pair", "rec_idx"]


def both_barcoded(config: dict) -> bool:
    return bool(config.get("barcode_struct_r2", {}).get("blocks"))


def _some(rows: DataFrame | fastq.Reads, pair: int | None = None, mate: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of one pair of files, one mate, or up to a record number; of files, no others are read."""
    if isinstance(rows, fastq.Reads):
        return rows.rows(pair, mate, last)
    for name, value in (("file_pair", pair), ("mate", mate)):
        rows = rows if value is None else rows.where(F.col(name) == value)
    return rows if last is None else rows.where(F.col("rec_idx") <= last)


def barcode_mate(rows: DataFrame | fastq.Reads, layout: Layout, either_strand: bool) -> int:
    """Which mate (1 or 2) holds the barcodes: the one with the better mean score, 2 if alike."""
    sample = _some(rows, pair=0, last=ORIENTATION_SAMPLE)
    found = {r["mate"]: r["score"] for r in aligned(sample, layout, either_strand).groupBy("mate").agg(F.avg("score").alias("score")).collect()}
    return 1 if found.get(1, float("-inf")) > found.get(2, float("-inf")) else 2


def _cut(found: DataFrame, forward_slice: bool) -> DataFrame:
    """Decoded reads over their file's threshold, cut after the barcodes.

    ``forward_slice`` cuts the read as it was given, even where its other strand was aligned;
    otherwise that strand is what is left.
    """
    good = found.where(F.col("passes") & F.col("end_pos").isNotNull())
    cut = F.substr("seq", F.col("end_pos") + 1)
    gone = ("trimmed", "end_pos", "score", "passes", "mate")
    if forward_slice:
        return good.withColumns({"seq": cut, "qual": F.substr("qual", F.col("end_pos") + 1)}).drop(*gone)
    as_given = cut == F.col("trimmed")
    qual = F.substr(F.when(as_given, F.col("qual")).otherwise(F.reverse("qual")), F.col("end_pos") + 1)
    return good.withColumns({"qual": qual, "seq": F.col("trimmed")}).drop(*gone)


def extracted(rows: DataFrame | fastq.Reads, config: dict) -> dict[int, DataFrame]:
    """For each mate with barcodes its reads with tags, written, and ``passes``, by a written threshold for each pair of files."""
    either, first = bool(config["unknown_read_orientation"]), Layout.of(config["barcode_struct_r1"])
    layouts = {1: first, 2: Layout.of(config["barcode_struct_r2"])} if both_barcoded(config) else {barcode_mate(rows, first, either): first}
    found = {m: written(extract(_some(rows, mate=m), x, either), "extracted") for m, x in layouts.items()}
    return {m: reads.judged(x, thresholds=written(reads.score_thresholds(x), "thresholds")) for m, x in found.items()}


def paired_up(rows: DataFrame | fastq.Reads, found: dict[int, DataFrame], forward_slice: bool = True) -> DataFrame:
    """One row for each pair that passes: tags, and read_id, description, seq and qual of both mates.

    ``found`` as :func:`extracted` gives it. With barcodes in both mates both have to pass,
    strings are dot-joined and linker lengths added.
    """
    mates = {m: _cut(found[m], forward_slice) if m in found else _some(rows, mate=m).drop("mate") for m in (1, 2)}
    joined, two, mate = reads.pair_reads(mates[1], mates[2]), len(found) == 2, min(found)
    tags = {n: F.concat_ws(".", f"{n}_1", f"{n}_2") if two else F.col(f"{n}_{mate}") for n in ("cb", "cr", "ur")}
    tags["fl"] = F.col("fl_1") + F.col("fl_2") if two else F.col(f"fl_{mate}")
    names = [f"{n}_{i}" for i in (1, 2) for n in ("read_id", "description", "seq", "qual")]
    return joined.select(*_KEY, F.lit(mate).alias("barcode_mate"), *(c.alias(n) for n, c in tags.items()), *names)


def extracted_pairs(rows: DataFrame | fastq.Reads, config: dict, forward_slice: bool = True) -> DataFrame:
    """Passing pairs of ``rows`` as :func:`cellweave.sources.fastq.read` gives them."""
    return paired_up(rows, extracted(rows, config), forward_slice)


def counters(found: dict[int, DataFrame], pairs: DataFrame) -> DataFrame:
    """(key, n): for each pair of files and barcoded mate the records read, decoded and at the threshold, and the pairs written."""
    of = lambda *parts: F.concat_ws(" ", *(F.lit(x) if isinstance(x, str) else x for x in parts))
    pair = F.col("file_pair").cast("string")
    out = pairs.groupBy("file_pair").agg(F.count("*").alias("n")).select(of("pair", pair, "written").alias("key"), "n")
    for mate, rows in found.items():
        each = rows.groupBy("file_pair").agg(F.count("*").alias("read"), F.count_if(F.col("end_pos").isNotNull()).alias("decoded"), F.count_if("passes").alias("passing"))
        named = each.unpivot("file_pair", ["read", "decoded", "passing"], "what", "n")
        out = out.unionByName(named.select(of("pair", pair, f"mate {mate}", F.col("what")).alias("key"), "n"))
    return out


def name_positions(rows: DataFrame | fastq.Reads) -> dict[int, list[int]]:
    """For each pair of files the places in which mates' names differ, from their first records."""
    heads = _some(rows, last=0).groupBy("file_pair").pivot("mate", [1, 2]).agg(F.first("read_id"))
    return {r["file_pair"]: files.difference_positions(r["1"] or "", r["2"] or "") for r in heads.collect()}


def preprocess(spark: SparkSession, folder: str, config: dict, out: str, forward_slice: bool = True) -> DataFrame:
    """Write ``out/reads`` (FASTQ without barcodes), ``out/tags``, ``out/tag-lines``, ``out/names`` and ``out/counters``; give the tags back.

    A mate with barcodes is written only if its struct keeps what is left of it. The parts appear
    together; an output that is finished is an error. Read files are counted where they have several shares,
    and each mate is read once.
    """
    pairs = files.paired(folder)
    with Output(spark, out) as output, run_scope(spark):
        rows = fastq.Reads(spark, pairs)
        places = name_positions(rows)
        mates = extracted(rows, config)
        found = written(paired_up(rows, mates, forward_slice), "pairs")
        names = spark.createDataFrame([(i, files.prefix(a), files.prefix(b)) for i, (a, b) in enumerate(pairs)], "file_pair int, name_1 string, name_2 string")
        keep = {1: bool(config["barcode_struct_r1"].get("keep_nonbarcode")), 2: bool(config.get("barcode_struct_r2", {}).get("keep_nonbarcode"))}
        two = both_barcoded(config)
        sides = []
        for i in (1, 2):
            wanted = F.lit(keep[i]) if two else (F.col("barcode_mate") != i) | F.lit(keep[1])
            side = found.join(F.broadcast(names), "file_pair").where(wanted)
            sides.append(side.select(F.concat(F.lit("sans_bc_"), f"name_{i}").alias("name"), "rec_idx", *(F.col(f"{n}_{i}").alias(n) for n in ("description", "seq", "qual"))))
        fastq.write(sides[0].unionByName(sides[1]), output.path("reads"))
        lists.write_counters(counters(mates, found), output.path("counters"))
        spark.createDataFrame(list(places.items()) or [], "file_pair int, positions array<int>").write.parquet(output.path("names"))
        tags = found.select("file_pair", F.when(F.col("barcode_mate") == 1, F.col("read_id_1")).otherwise(F.col("read_id_2")).alias("read_id"), "cb", "cr", "fl", "ur")
        reads.format_tags(tags).write.text(output.path("tag-lines"))
        tags.write.parquet(output.path("tags"))
    return spark.read.parquet(part(out, "tags"))


def with_umis(rows: DataFrame) -> DataFrame:
    """Tagged alignments with corrected UMIs; those without features go."""
    rows = written(rows, "tagged")
    return umi.apply(rows, umi.corrected(umi.umi_counts(rows), counted=True))


def matrices(rows: DataFrame, out: str) -> list[str]:
    """Write the matrices of tagged alignments: reads, and UMIs where there are any; give their names."""
    with run_scope(rows.sparkSession):
        counted = rows.where("ub IS NOT NULL").limit(1).count() > 0
        made, value = {"raw_reads_bc_matrix": matrix.read_matrix(rows)}, {"raw_reads_bc_matrix": "n_reads"}
        if counted:
            made["raw_umis_bc_matrix"], value["raw_umis_bc_matrix"] = matrix.umi_matrix(rows), "n_umis"
        market.write(made, rows, out, value)
    return list(made)


def count(rows: DataFrame, tags: DataFrame, positions: list[int] | dict[int, list[int]], out: str) -> DataFrame:
    """Tag alignments by their reads' names, correct UMIs, write ``out/alignments`` and the matrices.

    Where pairs of files number their mates at different places of the names, ``rows`` have to
    tell their ``file_pair``. What is written appears together; an output that is finished is an error.
    """
    if isinstance(positions, dict):
        if len({tuple(p) for p in positions.values()}) < 2:
            positions = next(iter(positions.values()), [])
        elif "file_pair" not in rows.columns:
            raise ValueError("pairs of files number their mates at different places: give each pair's alignments by itself")
    spark = rows.sparkSession
    with Output(spark, out) as output, run_scope(spark):
        known = rows.drop("cb", "cr", "ur", "ub", "fl", "path_no")
        tagged = reads.annotate(known, tags, positions) if isinstance(positions, dict) else reads.annotate(known, tags.drop("file_pair"), positions)
        umis = tags.where("ur IS NOT NULL").limit(1).count() > 0
        made = with_umis(tagged) if umis else tagged.withColumn("ub", F.lit(None).cast("string"))
        sam.coordinate_sorted(made).write.parquet(output.path("alignments"))
        staged = output.path("alignments").rpartition("/")[0]
        for name in matrices(spark.read.parquet(output.path("alignments")), staged):
            output.path(name)
    return spark.read.parquet(part(out, "alignments"))


def count_reads(spark: SparkSession, folder: str, config: dict, paths: list[str], out: str, prepared: str | None = None) -> DataFrame:
    """From read files and their alignments to matrices; ``prepared`` is where :func:`preprocess` wrote, if it has run.

    ``paths``: alignments, one of each pair of files in order if there are as many.
    """
    if not prepared:
        prepared = f"{out}/preprocessed"
        if not files.exists(f"{prepared}/{MANIFEST}"):  # else an earlier run got so far
            preprocess(spark, folder, config, prepared)
    tags = spark.read.parquet(part(prepared, "tags"))
    places = {r["file_pair"]: list(r["positions"]) for r in spark.read.parquet(part(prepared, "names")).collect()}
    rows = load_alignments(spark, paths)
    if len(paths) == len(places) > 1:
        rows = rows.withColumn("file_pair", F.array(*(F.lit(p) for p in sorted(places)))[F.col("path_no")])
    return count(rows, tags, places, out)


def load_alignments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Alignments from BAM files or folders of them, SAM text or Parquet, by the first path's ending.

    ``path_no`` is the place of a record's path among those given, and what ``align_ordinal``
    orders by first: several files are one whole, in the order given.
    """
    if paths[0].endswith(".bam"):
        return sam.read_bam(spark, paths)
    if paths[0].endswith((".sam", ".sam.gz")):
        return sam.read_sam(spark, paths)
    found = None
    for i, path in enumerate(paths):
        rows = spark.read.parquet(path).withColumn("path_no", F.lit(i))
        if "align_ordinal" in rows.columns:
            rows = rows.withColumn("align_ordinal", F.struct(F.lit(i).alias("path"), F.col("align_ordinal").alias("place")))
        found = rows if found is None else found.unionByName(rows)
    return found
