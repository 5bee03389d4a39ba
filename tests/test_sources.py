"""Files in and out, simulated reads through the whole way to matrices, and the stream."""

import gzip
import io
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.jobs import count as jobs
from cellweave.operators.extract import Layout
from cellweave.sources import alignments as sam
from cellweave.sources import fastq, files, market, simulate
from cellweave.streaming.extraction import extract_stream

LISTS = ("AACCGGTT", "CCTTAAGG", "GGAATTCC", "TTGGCCAA"), ("ACACACAC", "GTGTGTGT", "CAGTCAGT")
STRUCT = {"keep_nonbarcode": True, "blocks": [
    {"blocktype": "barcodeList", "blockfunction": "cellBarcode", "maxerrors": 1, "sequence": list(LISTS[0])},
    {"blocktype": "constantRegion", "blockfunction": "linker", "maxerrors": 1, "sequence": ["GATTACAGATC", "GATTACAGATCT"]},
    {"blocktype": "barcodeList", "blockfunction": "cellBarcode", "maxerrors": 1, "sequence": list(LISTS[1])},
    {"blocktype": "randomBarcode", "blockfunction": "UMI", "length": 8, "maxerrors": 1},
]}
CONFIG = {"unknown_read_orientation": False, "barcode_struct_r1": STRUCT}


def text_of(folder):
    return "".join((gzip.open if p.suffix == ".gz" else open)(p, "rt").read() for p in sorted(folder.glob("part-*")))


def test_records():
    raw = b"@a one\nAC\nGT\n+\n@@\n@@\n\n@b\n\n+\n\n@c\r\nA\r\n+c\r\nE\r\n"
    assert list(fastq.records(io.BytesIO(raw))) == [("a one", "ACGT", "@@@@"), ("b", "", ""), ("c", "A", "E")]
    for bad in (b"x\n", b"@a\nAC\n", b"@a\nAC\n+\nE\n"):
        with pytest.raises(ValueError):
            list(fastq.records(io.BytesIO(bad)))


def test_names(tmp_path):
    assert files.names_pair("x_1.fq", "x_2.fq") and not files.names_pair("x_1.fq", "y_2.fq") and files.names_pair("", "x")
    assert files.difference_positions("r/1", "r/2") == [2] and files.prefix("/a/b.c_1.fastq.gz") == "b.c_1"
    for name in ("b_1.fq", "b_2.fq", "a_1.txt.gz", "a_2.txt.gz", "other.json"):
        (tmp_path / name).write_text("")
    assert [files.prefix(p) for pair in files.paired(str(tmp_path)) for p in pair] == ["a_1", "a_2", "b_1", "b_2"]
    (tmp_path / "c.fq").write_text("")
    with pytest.raises(ValueError, match="odd"):
        files.paired(str(tmp_path))


def test_simulated(spark):
    clean = simulate.simulated(spark, [STRUCT], 40, error=-1, substitution=1.0).collect()
    assert sorted(r.rec_idx for r in clean) == list(range(40))
    pool = {r.read_id.split("_")[4] for r in clean if r.rec_idx <= 20}
    assert all(r.read_id.split("_")[4] in pool for r in clean) and all(len(r.seq) == len(r.qual) for r in clean)
    assert clean == simulate.simulated(spark, [STRUCT], 40, error=-1, substitution=1.0).repartition(3).orderBy("rec_idx").collect()
    words = spark.createDataFrame([(i, w) for i, w in enumerate(["ACGTACGT"] * 60 + ["A", ""])], "i int, w string")
    made = words.select("w", *(simulate.mutated(F.col("w"), 2, *how, F.col("i")).alias(n) for n, how in {"x": (0, 1.0, 0), "gone": (0, 0, 0), "more": (0, 0, 1.0), "some": (0.3, 0.5, 0.5)}.items())).collect()
    assert all(len(r.x) == len(r.w) and sum(a != b for a, b in zip(r.w, r.x, strict=True)) == min(2, len(r.w)) for r in made)
    assert all(len(r.gone) == max(0, len(r.w) - 2) and len(r.more) == len(r.w) + min(2, len(r.w)) for r in made)
    assert len({r.some for r in made}) > 20 and max(len(r.some) for r in made) > 8 > min(len(r.some) for r in made[:60])
    sizes = [len(r.seq) - 8 - len(r.read_id.split("_")[2]) - 8 - 8 for r in simulate.simulated(spark, [STRUCT], 2000, error=-1, substitution=1.0, seed=3).collect()]
    assert abs(np.mean(sizes) - simulate.TAIL) < 0.5 and abs(np.var(sizes) - simulate.TAIL) < 2.5


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("reads")
    rows = simulate.simulated(spark, [STRUCT], 200, error=1e-9).orderBy("rec_idx").collect()
    with gzip.open(out / "x_1.txt", "wt") as f:  # zipped, whatever its name says
        f.writelines(f"@m1:{r.read_id} more\n{r.seq}\n+\n{r.qual}\n" for r in rows)
    with open(out / "x_2.txt", "w") as f:
        f.writelines(f"@m2:{r.read_id}\n{'ACGT' * 5}\n+\n{'F' * 20}\n" for r in rows[:-1])
    return out


def test_files_to_matrices(spark, folder, tmp_path):
    rows = fastq.read(spark, files.paired(str(folder)))
    assert rows.count() == 399
    assert jobs.barcode_mate(rows, Layout.of(STRUCT), False) == 1
    tags = jobs.preprocess(spark, str(folder), CONFIG, str(tmp_path / "pre")).collect()
    assert len(tags) > 150
    for t in tags:
        _, a, linker, b, umi = t.read_id.split("_")
        assert (t.cb, t.cr, t.ur, t.fl) == (f"{a}.{b}", f"{a}.{b}", umi, len(linker))
    given = {r.description: r.seq for r in rows.where("mate = 1").collect()}
    left = list(fastq.records(io.BytesIO(text_of(tmp_path / "pre" / "reads" / "name=sans_bc_x_1").encode())))
    assert len(left) == len(tags) and all(given[title].endswith(seq) for title, seq, _ in left)
    assert [int(t[3:].split("_")[0]) for t, _, _ in left] == sorted(int(t[3:].split("_")[0]) for t, _, _ in left)
    other = list(fastq.records(io.BytesIO(text_of(tmp_path / "pre" / "reads" / "name=sans_bc_x_2").encode())))
    assert len(other) == len(tags) and {s for _, s, _ in other} == {"ACGT" * 5}

    lines = "@SQ\tSN:r\tLN:9\n" + "".join(f"{t.read_id.replace('m1:', 'm2:')}\t0\tr\t{i + 1}\t255\t20M\t*\t0\t0\t{'ACGT' * 5}\t{'F' * 20}\tGX:Z:g{i % 2};h\tGN:Z:G{i % 2};H\n" for i, t in enumerate(tags))
    (tmp_path / "x.sam").write_text(lines + "off\t4\t*\t0\t0\t*\t*\t0\t0\tA\tE\n")
    found = sam.read_sam(spark, str(tmp_path / "x.sam"))
    assert found.count() == len(tags)
    done = jobs.count(found, spark.read.parquet(str(tmp_path / "pre" / "tags")), jobs.name_positions(rows), str(tmp_path / "out"))
    assert done.count() == len(tags) and done.where("ub IS NULL").count() == 0
    made = {}
    for name in ("raw_reads_bc_matrix", "raw_umis_bc_matrix"):
        text = text_of(tmp_path / "out" / name / "matrix.mtx.gz").splitlines()
        cells, genes = (text_of(tmp_path / "out" / name / f"{n}.tsv.gz").splitlines() for n in ("barcodes", "features"))
        assert text[0] == "%%MatrixMarket matrix coordinate integer general" and cells == sorted({t.cb for t in tags})
        assert genes == [f"{g}\t{g.upper()}\tGene Expression" for g in ("g0", "g1", "h")]
        assert [int(x) for x in text[2].split()] == [3, len(cells), len(text) - 3]
        made[name] = {(genes[int(i) - 1].split("\t")[0], cells[int(j) - 1]): int(n) for i, j, n in (x.split() for x in text[3:])}
    want: dict = {}
    for i, t in enumerate(tags):
        for g in (f"g{i % 2}", "h"):
            want[g, t.cb] = want.get((g, t.cb), 0) + 1
    assert made["raw_reads_bc_matrix"] == want
    assert all(0 < n <= want[k] for k, n in made["raw_umis_bc_matrix"].items())
    sam.write_sam(done, str(tmp_path / "again"))
    back = sam.read_sam(spark, str(tmp_path / "again"))
    assert sorted(map(tuple, back.select("query_name", "pos", "gx", "cb", "ub", "fl").collect())) == sorted(map(tuple, done.select("query_name", "pos", "gx", "cb", "ub", "fl").collect()))


def test_both_mates(spark):
    rows = simulate.simulated(spark, [STRUCT, STRUCT], 60, error=1e-9).withColumn("file_pair", F.lit(0))
    got = jobs.extracted_pairs(rows, CONFIG | {"barcode_struct_r2": STRUCT}).collect()
    assert len(got) > 40
    for r in got:
        (_, a, x, b, u), (_, c, y, d, v) = r.read_id_1.split("_"), r.read_id_2.split("_")
        assert (r.cb, r.ur, r.fl) == (f"{a}.{b}.{c}.{d}", f"{u}.{v}", len(x) + len(y))


def test_bam(spark, tmp_path):
    def record(name, flag, ref, pos, tags):
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 9, 0, 1, flag, 3, -1, -1, 0) + name.encode() + b"\0" + struct.pack("<I", 3 << 4) + bytes([0x12, 0x40]) + bytes([30, 31, 32]) + tags
        return struct.pack("<i", len(body)) + body

    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 3) + b"r1\0" + struct.pack("<i", 100)
    tags = b"GXZa;b\0" + b"NHC\1" + b"XBBs" + struct.pack("<ihh", 2, 3, 4) + b"FLi" + struct.pack("<i", 11) + b"XAAq" + b"XFf" + struct.pack("<f", 0.5)
    with gzip.open(tmp_path / "x.bam", "wb") as f:
        f.write(head + record("one", 0x41, 0, 7, tags) + record("two", 4, -1, -1, b""))
    (got,) = sam.read_bam(spark, [str(tmp_path / "x.bam")]).collect()
    assert (got.query_name, got.ref, got.pos, got.cigar, got.seq, got.qual, got.gx, got.gn, got.fl) == ("one", "r1", 7, "3M", "ACG", "?@A", "a;b", None, 11)
    assert got.is_paired and got.is_read1 and not got.is_read2


def test_places(spark):
    rows = spark.range(500).select(F.format_string("%04d", F.pmod(F.col("id") * 7919, F.lit(500))).alias("label"))
    got = market.numbered(rows, "label").orderBy("label").collect()
    assert [r.place for r in got] == list(range(1, 501)) and [int(r.label) for r in got] == list(range(500))


def test_stream(spark, tmp_path):
    rows = simulate.simulated(spark, [STRUCT], 40, error=1e-9)
    rows.where("rec_idx < 20").write.parquet(str(tmp_path / "in"))
    schema = rows.schema
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        extract_stream(stream, Layout.of(STRUCT), 0.0, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        rows.where("rec_idx >= 20").write.mode("append").parquet(str(tmp_path / "in"))
    got = spark.read.parquet(str(tmp_path / "out")).select("rec_idx", "read_id", "ur").collect()
    assert len({r.rec_idx for r in got}) == len(got) > 30 and all(r.ur == r.read_id.split("_")[4] for r in got)


def test_ranges_of_records_are_found_by_their_numbers(spark, tmp_path, monkeypatch):
    """Rows are made once for it: a count of the rows that a run makes, the first pass for numbers aside."""
    made = spark.sparkContext.accumulator(0)

    def letters(i):
        made.add(1)
        return "ACGT"

    monkeypatch.setattr(fastq, "PART", 30)
    monkeypatch.setattr(fastq, "ROWS", 1)
    rows = spark.range(200).select(F.when(F.col("id") < 150, "x_1").otherwise("x_2").alias("name"), F.abs(149 - F.col("id")).alias("rec_idx"), F.col("id").cast("string").alias("description"), F.lit("FFFF").alias("qual"), F.udf(letters)("id").alias("seq"))
    fastq.write(rows, str(tmp_path / "out"))
    assert made.value == 200
    parts = sorted((tmp_path / "out" / "name=x_1").glob("part-*"))
    assert len(parts) > 1 and max(len(p.read_text().splitlines()) for p in parts) <= 4 * 30
    got = [line.removeprefix("@") for p in parts for line in p.read_text().splitlines()[::4]]
    want = [r["description"] for r in rows.where("name = 'x_1'").orderBy("rec_idx").select("description").collect()]
    assert got == want


def test_ranges_of_records_whose_numbers_lie_far_apart(spark, tmp_path):
    rows = spark.range(60).select(F.lit("x_1").alias("name"), F.expr("CASE WHEN id < 50 THEN id ELSE id * 1000000007 END").alias("rec_idx"), F.col("id").cast("string").alias("description"), F.lit("A").alias("seq"), F.lit("F").alias("qual"))
    fastq.write(rows.repartition(5), str(tmp_path / "out"))
    parts = sorted((tmp_path / "out" / "name=x_1").glob("part-*"))
    assert [line[1:] for p in parts for line in p.read_text().splitlines()[::4]] == [str(i) for i in range(60)]
