"""Queries that go through files and through extraction, over the driver's tables, and SQL for each."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.functions.sequences import reverse_complement
from cellweave.jobs import count as jobs
from cellweave.jobs.registry import _ALL, _COUNTABLE, _COUNTS, _FEATURES, _LAYOUT, _PARENTS, _ROOTS, ORACLE_SQL, QUERIES, _ctes, _near, _query
from cellweave.operators import extract, matrix, reads
from cellweave.session import fresh_path, written
from cellweave.sources import alignments as sam
from cellweave.sources import fastq, files, lists, market, simulate
from cellweave.sources.bridge import KINDS, LINKER, OTHER_LINKER, alignments, dna, kinds

__all__ = ["ORACLE_SQL", "QUERIES"]

_KINDS = KINDS.replace("as string", "as varchar")
_REFERENCES = [(f"chr{i}", 1000) for i in range(3)]
_FIRST = _LAYOUT.blocks[0]
_UMI = extract.Block("randomBarcode", "UMI", length=6)


# ---------------------------------------------------------------- files

_MATES = f"""mates AS (SELECT file_pair, 1 AS mate, rec_idx, name || '/1' AS read_id, cr || linker || ur || tail AS seq FROM ({_KINDS})
 UNION ALL SELECT file_pair, 2, rec_idx, name || '/2', other FROM ({_KINDS}))"""


def _read_files(spark: SparkSession, sf_dir: str, barcoded: int = 1) -> str:
    """A folder with a pair of read files for each of two pairs."""
    folder = fresh_path(spark, "reads")
    fastq.write(_both_mates(spark, sf_dir, barcoded), folder)
    return folder


def _read_again(spark: SparkSession, sf_dir: str, barcoded: int = 1, share: int = fastq.SHARE) -> DataFrame:
    return fastq.read(spark, files.paired(_read_files(spark, sf_dir, barcoded)), share)


def _both_mates(spark: SparkSession, sf_dir: str, barcoded: int = 1) -> DataFrame:
    """Both mates' records under the names of their files."""
    rows = kinds(spark, sf_dir)
    sides = [rows.select("file_pair", F.lit(m).alias("mate"), "rec_idx", F.concat("name", F.lit(f"/{m}")).alias("read_id"), seq.alias("seq")) for m, seq in (
        (barcoded, F.concat("cr", "linker", "ur", "tail")), (3 - barcoded, F.col("other")))]
    return sides[0].unionByName(sides[1]).select(
        F.format_string("x%d_%d", F.col("file_pair"), F.col("mate")).alias("name"), "rec_idx", F.concat_ws(" ", "read_id", F.lit("more")).alias("description"), "seq", F.repeat(F.lit("F"), F.length("seq")).alias("qual"),
    )


@_query("fastq_round_trip", _ctes(_MATES) + "SELECT *, read_id || ' more' AS description, repeat('F', length(seq)) AS qual FROM mates")
def fastq_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_again(spark, sf_dir)


@_query("fastq_by_ranges", _ctes(_MATES) + "SELECT *, read_id || ' more' AS description, repeat('F', length(seq)) AS qual FROM mates")
def fastq_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through shares of 20,000 bytes, which begin and end inside records."""
    return _read_again(spark, sf_dir, share=20_000)


_RECORD = f"""rec AS (SELECT *, cast(CASE WHEN is_paired THEN 1 ELSE 0 END + CASE WHEN is_reverse THEN 16 ELSE 0 END + CASE WHEN is_read1 THEN 64 ELSE 0 END
 + CASE WHEN is_read2 THEN 128 ELSE 0 END + CASE WHEN mate_is_unmapped THEN 8 ELSE 0 END AS int) AS flag, cast(read_no % 60 as int) AS mapq, '10M2D5M' AS cigar,
 {dna("read_no", 15).replace("as string", "as varchar")} AS seq, repeat('F', 15) AS qual, 11 AS fl FROM aln)"""
_SEEN = ["query_name", "flag", "ref", "pos", "mapq", "cigar", "seq", "qual", "gx", "gn", "cb", "cr", "ur", "fl", "is_paired", "is_reverse", "is_read1", "is_read2", "mate_is_unmapped"]


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir)
    bits = sum((F.when(F.col(c), b).otherwise(0) for c, b in (("is_reverse", 16), ("is_read1", 64), ("is_read2", 128), ("mate_is_unmapped", 8))), F.when(F.col("is_paired"), 1).otherwise(0))
    return rows.withColumns({
        "flag": bits.cast("int"), "mapq": (F.col("read_no") % 60).cast("int"), "cigar": F.lit("10M2D5M"), "seq": F.expr(dna("read_no", 15)), "qual": F.repeat(F.lit("F"), F.lit(15)), "fl": F.lit(11),
    })


@_query("sam_round_trip", _ctes(_RECORD) + f"SELECT {', '.join(_SEEN)} FROM rec")
def sam_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "sam")
    sam.write_sam(_records(spark, sf_dir), folder, _REFERENCES)
    return sam.read_sam(spark, folder).select(_SEEN)


def _bam(spark: SparkSession, sf_dir: str, share: int = sam.SHARE, region: sam.Region | None = None, more: bool = False) -> DataFrame:
    folder = fresh_path(spark, "bam")
    rows = _records(spark, sf_dir)
    sam.write_bam(rows.withColumns({n: F.expr(x) for n, x in _MORE.items()}) if more else rows, folder, _REFERENCES)
    return sam.read_bam(spark, [folder], share, more, region)


@_query("bam_round_trip", _ctes(_RECORD) + f"SELECT {', '.join(_SEEN)} FROM rec")
def bam_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bam(spark, sf_dir).select(_SEEN)


@_query("bam_of_one_reference", _ctes(_RECORD) + f"SELECT {', '.join(_SEEN)} FROM rec WHERE ref = 'chr1'")
def bam_of_one_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bam(spark, sf_dir, region=sam.Region(("chr1",))).select(_SEEN)


@_query("bam_of_a_region", _ctes(_RECORD) + f"SELECT {', '.join(_SEEN)} FROM rec WHERE ref IN ('chr0', 'chr2') AND pos >= 1 AND pos < 3")
def bam_of_a_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two references' records of some places, through parts' spans, indexes and small shares."""
    return _bam(spark, sf_dir, 40_000, sam.Region(("chr0", "chr2"), 1, 3)).select(_SEEN)


#: Fields of mates, records without a place, and tags of every type.
_MORE = {
    "flag": "cast(CASE WHEN read_no % 13 = 0 THEN 4 ELSE flag END AS int)", "ref": "CASE WHEN read_no % 13 = 0 THEN '*' ELSE ref END", "pos": "CASE WHEN read_no % 13 = 0 THEN -1 ELSE pos END",
    "mate_ref": "CASE read_no % 3 WHEN 0 THEN 'chr2' WHEN 1 THEN '*' ELSE 'chr0' END", "mate_pos": "CASE WHEN read_no % 3 = 1 THEN -1 ELSE read_no % 900 END", "template_length": "cast(250 - read_no % 500 AS int)",
    "tags": "array('NM:C:' || (read_no % 200), 'AS:i:' || (-read_no), 'XA:A:q', 'XB:B:S,7,' || (read_no % 60000), 'XF:f:0.5', 'XZ:Z:a:' || (read_no % 7), 'GX:Z:hidden')",
}


@_query("bam_whole_records", _ctes(_RECORD) + """SELECT query_name, cast(CASE WHEN read_no % 13 = 0 THEN 4 ELSE flag END AS int) AS flag, CASE WHEN read_no % 13 = 0 THEN '*' ELSE ref END AS ref, CASE WHEN read_no % 13 = 0 THEN -1 ELSE pos END AS pos,
 CASE read_no % 3 WHEN 0 THEN 'chr2' WHEN 1 THEN '*' ELSE 'chr0' END AS mate_ref, CASE WHEN read_no % 3 = 1 THEN -1 ELSE read_no % 900 END AS mate_pos, cast(250 - read_no % 500 AS int) AS template_length, gx, cb,
 'NM:C:' || (read_no % 200) || '|AS:i:' || (-read_no) || '|XA:A:q|XB:B:S,7,' || (read_no % 60000) || '|XF:f:0.5|XZ:Z:a:' || (read_no % 7) AS tags FROM rec""")  # fmt: skip
def bam_whole_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of mates, records without a place and tags that no column stands for, with their types, out and in again."""
    return _bam(spark, sf_dir, more=True).select("query_name", "flag", "ref", "pos", "mate_ref", "mate_pos", "template_length", "gx", "cb", F.array_join("tags", "|").alias("tags"))


@_query("bam_sorted_places", _ctes() + "SELECT query_name, row_number() OVER (ORDER BY ref, pos, is_reverse, read_no) AS place FROM aln")
def bam_sorted_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's place in the coordinate order of written files, read through shares of 30,000 bytes."""
    rows = _bam(spark, sf_dir, share=30_000).select("query_name", "align_ordinal.file", "align_ordinal.place")
    rows = written(rows.withColumn("at", F.row_number().over(Window.partitionBy("file").orderBy("place")) - 1), "places")
    # one row for each file
    sizes = rows.groupBy("file").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows.join(F.broadcast(sizes), "file").select("query_name", (F.col("before") + F.col("at") + 1).alias("place"))


@_query("matrix_market_round_trip", _ctes(_FEATURES) + f"SELECT fx AS gx, fn AS gn, cb, count(*) AS n FROM feat WHERE {_COUNTABLE} GROUP BY ALL")
def matrix_market_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, folder = alignments(spark, sf_dir), fresh_path(spark, "matrix")
    market.write({"reads": matrix.read_matrix(rows)}, rows, folder, {"reads": "n_reads"})
    return market.read(spark, f"{folder}/reads")


@_query("whitelist_file", _ctes() + "SELECT DISTINCT cb AS barcode FROM aln")
def whitelist_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "whitelist")
    alignments(spark, sf_dir).select(F.concat("cb", F.lit("-1")).alias("value")).distinct().write.text(path)
    paths = files.parts(path)
    found = lists.read_whitelist(spark, paths[0])
    for more in paths[1:]:
        found = found.unionByName(lists.read_whitelist(spark, more))
    return found


@_query("counter_lines", _ctes() + "SELECT ref AS key, ref || ': ' || format('{:,}', count(*)) AS line FROM aln GROUP BY ref")
def counter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.counter_lines(alignments(spark, sf_dir).groupBy(F.col("ref").alias("key")).agg(F.count("*").alias("n")))


# ---------------------------------------------------------------- extraction

_LINKERS = extract.Block("constantRegion", "linker", (LINKER, OTHER_LINKER))
_VARIED = extract.Layout((_FIRST, _LINKERS, _UMI))
_PICK = """, raws AS (SELECT DISTINCT {raw} AS raw FROM k), near AS (SELECT raw, barcode, CASE WHEN raw=barcode THEN 0 ELSE levenshtein(raw, barcode) END AS d FROM raws, wl WHERE levenshtein(raw, barcode)<=1),
 best AS (SELECT raw, min(d) AS d FROM near GROUP BY raw),
 pick AS (SELECT n.raw, CASE WHEN count(*)=1 THEN min(barcode) END AS d1 FROM near n JOIN best b ON n.raw=b.raw AND n.d=b.d GROUP BY n.raw)"""
#: What each kind of change does to the score of a template with one list, a linker and a UMI.
_SCORE = "CASE kind WHEN 1 THEN 8.9/25 WHEN 2 THEN 9.9/25 WHEN 3 THEN 9.9/25 WHEN 4 THEN 13.0/27 WHEN 5 THEN 9.0/25 ELSE 11.0/25 END"
_VARIED_SQL = _ctes(f"k AS ({_KINDS})", f"wl AS ({_ALL})") + _PICK.format(raw="raw").replace("SELECT DISTINCT raw AS raw FROM k", "SELECT DISTINCT raw FROM k") + f"""
 SELECT read_no, round({_SCORE}, 6) AS score, d1 AS cb, CASE WHEN d1 IS NOT NULL THEN k.raw END AS cr, CASE WHEN d1 IS NOT NULL THEN ur END AS ur,
 CASE WHEN d1 IS NOT NULL THEN CASE WHEN kind = 4 THEN 13 ELSE 11 END END AS fl, CASE WHEN d1 IS NOT NULL THEN tail END AS trimmed FROM k LEFT JOIN pick p ON k.raw = p.raw"""
_TAGGED = ["read_no", "round(score, 6) AS score", "cb", "cr", "ur", "fl", "trimmed"]


def _varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kinds(spark, sf_dir).select("read_no", F.concat("raw", "linker", "ur", "tail").alias("seq"))


@_query("extract_variants_and_indels", _VARIED_SQL)
def extract_variants_and_indels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two constants of different lengths; letters gone, put in and exchanged around the boundaries."""
    return extract.extract(_varied(spark, sf_dir), _VARIED).selectExpr(*_TAGGED)


@_query("extract_either_strand", _VARIED_SQL)
def extract_either_strand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every other read turned."""
    turned = F.when(F.col("read_no") % 2 == 1, reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    return extract.extract(_varied(spark, sf_dir).withColumn("seq", turned), _VARIED, True).selectExpr(*_TAGGED)


_SECOND_ALL = "w2 AS (SELECT DISTINCT second AS barcode FROM k)"


@_query("extract_two_lists", _ctes(f"k AS (SELECT *, substr(cr || '{LINKER}' || seconds || ur || tail, 20, 8) AS raw2 FROM ({_KINDS}))", f"wl AS ({_ALL})", _SECOND_ALL) + _PICK.format(raw="cr") + f""",
 raws2 AS (SELECT DISTINCT raw2 FROM k), near2 AS (SELECT raw2, barcode, CASE WHEN raw2=barcode THEN 0 ELSE 1 END AS d FROM raws2, w2 WHERE {_near('raw2', 'barcode')}),
 best2 AS (SELECT raw2, min(d) AS d FROM near2 GROUP BY raw2),
 pick2 AS (SELECT n.raw2, CASE WHEN count(*)=1 THEN min(barcode) END AS d2 FROM near2 n JOIN best2 b ON n.raw2=b.raw2 AND n.d=b.d GROUP BY n.raw2)
 SELECT read_no, round(11.0/33, 6) AS score, d1 || '.' || d2 AS cb, CASE WHEN d1 || d2 IS NOT NULL THEN cr || '.' || k.raw2 END AS cr, CASE WHEN d1 || d2 IS NOT NULL THEN ur END AS ur,
 CASE WHEN d1 || d2 IS NOT NULL THEN 11 END AS fl, CASE WHEN d1 || d2 IS NOT NULL THEN substr(cr || '{LINKER}' || seconds || ur || tail, 34) END AS trimmed
 FROM k LEFT JOIN pick p ON k.cr = p.raw LEFT JOIN pick2 q ON k.raw2 = q.raw2""")  # fmt: skip
def extract_two_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first list is decoded by edits, the last one, which a UMI follows, by free divergence; UMIs come from realigned reads."""
    rows = kinds(spark, sf_dir)
    second = tuple(r["second"] for r in rows.select("second").distinct().orderBy("second").limit(13).collect())  # a list of 13 barcodes, part of the layout
    layout = extract.Layout((_FIRST, extract.Block("constantRegion", "linker", (LINKER,)), extract.Block("barcodeList", "cellBarcode", second), _UMI))
    assert [layout.distance(i) for i in layout.places("barcodeList")] == ["levenshtein", "freediv"]
    return extract.extract(rows.select("read_no", F.concat("cr", F.lit(LINKER), "seconds", "ur", "tail").alias("seq")), layout).selectExpr(*_TAGGED)


# ---------------------------------------------------------------- whole runs

_BLOCKS = [
    {"blocktype": "barcodeList", "blockfunction": "cellBarcode", "sequence": list(_FIRST.sequence), "maxerrors": 1},
    {"blocktype": "constantRegion", "blockfunction": "linker", "sequence": [LINKER, OTHER_LINKER], "maxerrors": 1},
    {"blocktype": "randomBarcode", "blockfunction": "UMI", "length": 6, "maxerrors": 1},
]
_CONFIG = {"unknown_read_orientation": False, "barcode_struct_r1": {"keep_nonbarcode": True, "blocks": _BLOCKS}}

_CR_SCORE = _SCORE.replace("WHEN 3 THEN 9.9/25 ", "")
_PASSING = f"""sc AS (SELECT *, {_CR_SCORE} AS score FROM k), th AS (SELECT file_pair, avg(score) - 2*stddev_pop(score) AS t FROM sc WHERE rec_idx <= 10000 GROUP BY 1),
 ok AS (SELECT sc.*, d1, score >= t AS passes FROM sc JOIN th USING (file_pair) LEFT JOIN pick p ON sc.cr = p.raw)"""
_RUN = _ctes(f"k AS ({_KINDS})", f"wl AS ({_ALL})") + _PICK.format(raw="cr") + f", {_PASSING}"


@_query("barcode_mate", "SELECT 2 AS barcode_mate, count(*) AS n_reads FROM events")
def barcode_mate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which mate holds the barcodes where they are in the second."""
    rows = written(_read_again(spark, sf_dir, barcoded=2), "reads")
    mate = jobs.barcode_mate(rows, extract.Layout.of(_CONFIG["barcode_struct_r1"]), False)
    return rows.where(F.col("mate") == mate).groupBy(F.col("mate").alias("barcode_mate")).agg(F.count("*").alias("n_reads"))


@_query("preprocess_tags", _RUN + "SELECT file_pair, name || '/2' AS read_id, d1 AS cb, cr, ur, CASE WHEN kind = 4 THEN 13 ELSE 11 END AS fl FROM ok WHERE passes AND d1 IS NOT NULL")
def preprocess_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to tags, with barcodes in the second mate: mate, score threshold, decoding, pairs."""
    return jobs.preprocess(spark, _read_files(spark, sf_dir, barcoded=2), _CONFIG, fresh_path(spark, "preprocessed"))


@_query("preprocess_reads", _RUN + """SELECT cast(file_pair as int) AS file_pair, cast(m as int) AS mate, row_number() OVER (PARTITION BY file_pair, m ORDER BY rec_idx) - 1 AS rec_idx,
 name || CASE WHEN m = 2 THEN '/2' ELSE '/1' END AS read_id, CASE WHEN m = 2 THEN tail ELSE other END AS seq FROM ok, (SELECT unnest([1, 2]) AS m) WHERE passes AND d1 IS NOT NULL""")  # fmt: skip
def preprocess_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The read files that a run leaves, mates without their barcodes, read again."""
    out = fresh_path(spark, "preprocessed")
    jobs.preprocess(spark, _read_files(spark, sf_dir, barcoded=2), _CONFIG, out)
    return fastq.read(spark, files.paired(f"{out}/reads")).select("file_pair", "mate", "rec_idx", "read_id", "seq")


@_query("preprocess_counters", _RUN + """SELECT 'pair ' || file_pair || ' ' || what AS key, cast(n as bigint) AS n FROM (
 SELECT file_pair, unnest(['mate 1 read', 'mate 1 decoded', 'mate 1 passing', 'written']) AS what,
 unnest([count(*), count(d1), count(*) FILTER (passes), count(*) FILTER (passes AND d1 IS NOT NULL)]) AS n FROM ok GROUP BY file_pair)""")  # fmt: skip
def preprocess_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fastq.Reads(spark, files.paired(_read_files(spark, sf_dir)))
    found = jobs.extracted(rows, _CONFIG)
    return jobs.counters(found, jobs.paired_up(rows, found))


@_query("both_mates_tags", _RUN + """SELECT x.file_pair, x.rec_idx, x.d1 || '.' || y.d1 AS cb, x.cr || '.' || y.cr AS cr, x.ur || '.' || y.ur AS ur,
 CASE WHEN x.kind = 4 THEN 13 ELSE 11 END + CASE WHEN y.kind = 4 THEN 13 ELSE 11 END AS fl, x.tail AS seq_1, y.tail AS seq_2
 FROM ok x JOIN ok y ON y.file_pair = 1 - x.file_pair AND x.rec_idx = y.rec_idx WHERE x.passes AND y.passes AND x.d1 IS NOT NULL AND y.d1 IS NOT NULL""")  # fmt: skip
def both_mates_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes in both mates: both have to pass, tags are joined, linker lengths added."""
    rows = kinds(spark, sf_dir).withColumn("seq", F.concat("cr", "linker", "ur", "tail"))
    sides = [rows.select((F.col("file_pair") if m == 1 else 1 - F.col("file_pair")).cast("int").alias("file_pair"), F.lit(m).alias("mate"), "rec_idx", F.col("name").alias("read_id"),
                         F.col("name").alias("description"), "seq", F.repeat(F.lit("F"), F.length("seq")).alias("qual")) for m in (1, 2)]
    found = jobs.extracted_pairs(sides[0].unionByName(sides[1]), _CONFIG | {"barcode_struct_r2": _CONFIG["barcode_struct_r1"]})
    return found.select("file_pair", "rec_idx", "cb", "cr", "ur", "fl", "seq_1", "seq_2")


@_query("passing_reads", _ctes() + """SELECT read_no FROM aln JOIN (SELECT file_pair, avg(score) - 2*stddev_pop(score) AS t FROM aln WHERE read_no//4 <= 10000 GROUP BY 1) USING (file_pair) WHERE score >= t""")
def passing_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.passing(alignments(spark, sf_dir).withColumn("rec_idx", F.expr("read_no div 4"))).select("read_no")


_TAGGED_SQL = f""", tagged AS (SELECT a.* EXCLUDE (cb, cr, ur, file_pair, align_ordinal), ok.d1 AS cb, ok.ur, {{'f': ok.file_pair, 'o': a.read_no}} AS align_ordinal FROM ok JOIN aln a ON a.read_no = ok.read_no WHERE passes AND d1 IS NOT NULL),
 {_FEATURES.replace("FROM aln a", "FROM tagged a")}"""


def _counted(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """From read files and a BAM folder of each pair's alignments to matrices, through all steps' files.

    Positions are few, so UMIs of either pair's alignments tie in place with one another.
    """
    folder, out = _read_files(spark, sf_dir), fresh_path(spark, "counted")
    rows = _records(spark, sf_dir).withColumns({"query_name": F.concat(F.lit("r"), F.lpad(F.col("read_no").cast("string"), 12, "0"), F.lit("/2")), "pair": F.col("read_no") % 2}).drop("cb", "cr", "ur", "fl")
    paths = []
    for pair in (0, 1):
        paths.append(f"{out}/{'zy'[pair]}.bam")  # not in the order of names
        sam.write_bam(rows.where(F.col("pair") == pair), paths[-1], _REFERENCES)
    return out, jobs.count_reads(spark, folder, _CONFIG, paths, out)


@_query("count_run", _RUN + _TAGGED_SQL + f" SELECT fx AS gx, fn AS gn, cb, count(*) AS n FROM feat WHERE {_COUNTABLE} GROUP BY ALL")
def count_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix of reads of a whole run."""
    return market.read(spark, f"{_counted(spark, sf_dir)[0]}/raw_reads_bc_matrix")


_RUN_UBS = _RUN + _TAGGED_SQL + f", {_COUNTS}, {_PARENTS}, {_ROOTS}, own AS (SELECT f.*, u.ub FROM feat f JOIN feat g ON f.read_no=g.read_no AND g.i=1 JOIN ubs u ON u.ref=g.ref AND u.cb=g.cb AND u.gx=g.fx AND u.gn=g.fn AND u.ur=g.ur)"


@_query("count_run_umis", _RUN_UBS + f" SELECT gx, gn, cb, count(*) AS n FROM (SELECT DISTINCT ref, fx AS gx, fn AS gn, cb, ub FROM own WHERE {_COUNTABLE}) GROUP BY ALL")
def count_run_umis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix of UMIs of a whole run over two pairs of files."""
    return market.read(spark, f"{_counted(spark, sf_dir)[0]}/raw_umis_bc_matrix")


@_query("count_run_ubs", _RUN_UBS + " SELECT 'r' || lpad(cast(read_no as varchar), 12, '0') || '/2' AS query_name, cb, ur, ub FROM own WHERE i = 1")
def count_run_ubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each alignment's corrected UMI in a whole run over two pairs of files."""
    return _counted(spark, sf_dir)[1].select("query_name", "cb", "ur", "ub")


@_query("count_matrix_command", _ctes(_FEATURES) + f"SELECT fx AS gx, fn AS gn, cb, count(*) AS n FROM feat WHERE {_COUNTABLE} GROUP BY ALL")
def count_matrix_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command that counts tagged alignments, given a BAM folder."""
    from cellweave.__main__ import run

    folder, out = fresh_path(spark, "tagged") + ".bam", fresh_path(spark, "counted")
    sam.write_bam(_records(spark, sf_dir), folder, _REFERENCES)
    run(spark, ["count_matrix", folder, "--output-dir", out])
    return market.read(spark, f"{out}/raw_reads_bc_matrix")


@_query("preprocess_keeps_no_barcoded_mate", _RUN + """SELECT cast(file_pair as int) AS file_pair, row_number() OVER (PARTITION BY file_pair ORDER BY rec_idx) - 1 AS rec_idx, name || '/1' AS read_id, other AS seq FROM ok WHERE passes AND d1 IS NOT NULL""")
def preprocess_keeps_no_barcoded_mate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration, gzipped in a file, that keeps nothing of the mate with barcodes: one read file for each pair is left."""
    folder, out = fresh_path(spark, "config"), fresh_path(spark, "preprocessed")
    text = json.dumps(_CONFIG | {"barcode_struct_r1": {"keep_nonbarcode": False, "blocks": _BLOCKS}})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("compression", "gzip").text(folder)
    (path,) = files.parts(folder)
    jobs.preprocess(spark, _read_files(spark, sf_dir, barcoded=2), extract.read_config(path), out)
    left = [(f,) for f in files.listed_reads(f"{out}/reads")]
    return fastq.read(spark, left).select("file_pair", "rec_idx", "read_id", "seq")


@_query("fastq_gzipped", _ctes(_MATES) + "SELECT *, read_id || ' more' AS description, repeat('F', length(seq)) AS qual FROM mates")
def fastq_gzipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzipped parts, told by their content."""
    folder = fresh_path(spark, "reads")
    fastq.write(_both_mates(spark, sf_dir), folder, compression="gzip")
    return fastq.read(spark, files.paired(folder))


@_query("read_file_pairs", """SELECT cast(dense_rank() OVER (ORDER BY event_type) - 1 as int) AS file_pair, event_type || '_1.x' AS name_1, event_type || '_2.x' AS name_2, count(*) AS n_reads FROM events GROUP BY event_type""")
def read_file_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read files named by the type of their events: how they pair, what they are called, and how many reads a mate has."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.select(F.explode(F.array(*(F.concat("event_type", F.lit(f"_{m}.x.fq")) for m in (1, 2)))).alias("name"), F.col("event_id").alias("rec_idx"), F.col("event_id").cast("string").alias("description"), F.lit("ACGT").alias("seq"), F.lit("FFFF").alias("qual"))
    folder = fresh_path(spark, "reads")
    fastq.write(rows, folder)
    pairs = files.paired(folder)
    names = spark.createDataFrame([(i, files.prefix(a), files.prefix(b)) for i, (a, b) in enumerate(pairs)], "file_pair int, name_1 string, name_2 string")
    counted = fastq.Reads(spark, pairs).rows(mate=2).groupBy("file_pair").agg(F.count("*").alias("n_reads"))
    return names.join(counted, "file_pair").select("file_pair", "name_1", "name_2", "n_reads")


_FEW = "(CASE WHEN file_pair = 3 THEN read_no//4 + 1000 ELSE read_no//4 END)"


@_query("passing_reads_small_sample", _ctes() + f"SELECT read_no FROM aln LEFT JOIN (SELECT file_pair, avg(score) - 2*stddev_pop(score) AS t FROM aln WHERE {_FEW} <= 40 GROUP BY 1) USING (file_pair) WHERE t IS NULL OR score >= t")
def passing_reads_small_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds from each file's first 41 records; a file whose records begin beyond them lets all pass."""
    rows = alignments(spark, sf_dir).withColumn("rec_idx", F.expr("CASE WHEN file_pair = 3 THEN read_no div 4 + 1000 ELSE read_no div 4 END"))
    return reads.passing(rows, 40).select("read_no")


@_query("annotate_by_pair", _ctes() + "SELECT read_no, cb, ur FROM aln")
def annotate_by_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four pairs of files, which number their mates at four different places of the name."""
    rows = alignments(spark, sf_dir)
    number = F.lpad(F.col("read_no").cast("string"), 12, "0")
    at = (F.col("file_pair") * 3).cast("int")
    name = lambda mate: F.concat(F.substr(number, F.lit(1), at), F.lit(str(mate)), F.substr(number, at + 1, F.lit(12)))
    tags = rows.select("file_pair", name(1).alias("read_id"), "cb", "ur")
    return reads.annotate(rows.select("read_no", "file_pair", name(2).alias("query_name")), tags, {i: [3 * i] for i in range(4)}).select("read_no", "cb", "ur")


def _drawn(*parts: str) -> str:
    return f"cast('0x' || substr(md5({" || '.' || ".join(parts)}), 1, 8) AS bigint)"


def _simulated_sql() -> str:
    """The drawn barcode, linker and UMI of each event's read, by the digests that draw them."""
    listed = lambda seq: "[" + ", ".join(f"'{s}'" for s in seq) + "]"
    which = lambda place, seq: f"{listed(seq)}[1 + {_drawn("'42'", 'i', "'0'", f"'{place}'", "'which'")} % {len(seq)}]"
    umi = f"translate(substr(md5('42.' || (CASE WHEN e < pool THEN e ELSE {_drawn("'42'", 'i', "'0'", "'2'", "'of'")} % pool END) || '.0.2.0'), 1, 6), '0123456789abcdef', 'ATGCATGCATGCATGC')"
    return f"""SELECT e AS rec_idx, i || '_' || {which(0, _FIRST.sequence)} || '_' || {which(1, (LINKER, OTHER_LINKER))} || '_' || {umi} AS read_id,
 {which(0, _FIRST.sequence)} AS cb, {umi} AS ur, length({which(1, (LINKER, OTHER_LINKER))}) AS fl, true AS cut_found
 FROM (SELECT event_id AS e, cast(event_id AS varchar) AS i, least(cast(floor(0.5 * count(*) OVER ()) AS bigint) + 1, count(*) OVER ()) AS pool FROM events)"""


@_query("simulated_reads", _simulated_sql())
def simulated_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read without errors is drawn for each event, and its barcode, UMI and linker are found again."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("rec_idx"))
    made = simulate.reads_of(rows, [_CONFIG["barcode_struct_r1"]], rows.count(), error=1e-12)
    found = extract.extract(made, extract.Layout.of(_CONFIG["barcode_struct_r1"]))
    part = F.split("read_id", "_")
    whole = F.concat(part[1], part[2], part[3], "trimmed") == F.col("seq")
    return found.select("rec_idx", "read_id", "cb", "ur", F.col("fl").cast("long").alias("fl"), whole.alias("cut_found"))
