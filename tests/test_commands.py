"""The four commands one after the other, and files that are split."""

import gzip
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from cellweave.__main__ import run
from cellweave.operators.skew import split_join
from cellweave.operators.umi import edges
from cellweave.sources import alignments as sam
from cellweave.sources import fastq, files, lists, market

STRUCT = {"keep_nonbarcode": True, "blocks": [
    {"blocktype": "barcodeList", "blockfunction": "cellBarcode", "maxerrors": 1, "sequence": ["AACCGGTT", "CCTTAAGG", "GGAATTCC"]},
    {"blocktype": "constantRegion", "blockfunction": "linker", "maxerrors": 1, "sequence": ["GATTACAGATC"]},
    {"blocktype": "randomBarcode", "blockfunction": "UMI", "length": 8, "maxerrors": 1},
]}


def test_commands_one_after_the_other(spark, tmp_path):
    config = {"unknown_read_orientation": False, "barcode_struct_r1": STRUCT, "barcode_struct_r2": STRUCT}
    with gzip.open(tmp_path / "config.json", "wt") as f:
        json.dump(config, f)
    common = ["--config", str(tmp_path / "config.json")]
    run(spark, ["simulate_reads", *common, "--fastq-prefix", str(tmp_path / "reads" / "run"), "--nreads", "80", "--error-probability", "1e-9"])
    run(spark, ["preprocess", str(tmp_path / "reads"), *common, "--output-dir", str(tmp_path / "pre")])
    tags = spark.read.parquet(str(tmp_path / "pre" / "tags")).collect()
    assert len(tags) > 60
    rows = spark.createDataFrame([(t.read_id, 0, "chr1", i, 255, "5M", "ACGTA", "FFFFF", f"g{i % 3}", f"G{i % 3}") for i, t in enumerate(tags)],
                                 "query_name string, flag int, ref string, pos long, mapq int, cigar string, seq string, qual string, gx string, gn string")
    sam.write_bam(rows, str(tmp_path / "x.bam"), [("chr1", 1000)])
    run(spark, ["count", str(tmp_path / "reads"), *common, "--preprocessed", str(tmp_path / "pre"), "--alignments", str(tmp_path / "x.bam"), "--output-dir", str(tmp_path / "out")])
    truth: dict = {}
    for i, t in enumerate(tags):
        _, a, _, u, = t.read_id.split("_")[:4]
        assert t.cb.split(".")[0] == a and t.ur.split(".")[0] == u
        truth[f"g{i % 3}", t.cb] = truth.get((f"g{i % 3}", t.cb), 0) + 1
    made = market.read(spark, str(tmp_path / "out" / "raw_reads_bc_matrix"))
    assert {(r.gx, r.cb): r.n for r in made.collect()} == truth
    run(spark, ["count_matrix", str(tmp_path / "out" / "alignments"), "--output-dir", str(tmp_path / "again")])
    again = market.read(spark, str(tmp_path / "again" / "raw_umis_bc_matrix"))
    assert sorted(again.collect()) == sorted(market.read(spark, str(tmp_path / "out" / "raw_umis_bc_matrix")).collect())
    # a whole matrix is left as it is, one that a broken run left is written anew
    (tmp_path / "again" / "raw_reads_bc_matrix" / market.DONE).unlink()
    run(spark, ["count_matrix", str(tmp_path / "out" / "alignments"), "--output-dir", str(tmp_path / "again")])
    assert {(r.gx, r.cb): r.n for r in market.read(spark, str(tmp_path / "again" / "raw_reads_bc_matrix")).collect()} == truth
    with pytest.raises(FileExistsError):
        run(spark, ["preprocess", str(tmp_path / "reads"), *common, "--output-dir", str(tmp_path / "pre")])
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no read files"):
        run(spark, ["preprocess", str(tmp_path / "none"), *common, "--output-dir", str(tmp_path / "pre2")])


@pytest.mark.parametrize("share", [1, 7, 64, 300])
def test_fastq_shares_hold_each_record_once(tmp_path, share):
    rng = random.Random(share)
    made = [(f"r{i} x", "".join(rng.choice("ACGT") for _ in range(rng.randrange(9))), i) for i in range(60)]
    text = "".join(f"@{n}\n{s}\n+\n{'@' * len(s)}\n" for n, s, _ in made).encode()
    for whole in (text, text[:-1]):
        stream = io.BufferedReader(io.BytesIO(whole))
        got = [r for at in range(0, len(whole), share) for r in fastq._in_range(stream, at, min(at + share, len(whole)))]
        assert [(n, s) for n, s, _ in got] == [(n, s) for n, s, _ in made]


def test_bam_shares_meet(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"q{i:05d}", 0, "chr1", i, 9, "4M", "ACGT", "FFFF", "".join(rng.choice("ACGT") for _ in range(rng.randrange(400)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "query_name string, flag int, ref string, pos long, mapq int, cigar string, seq string, qual string, cr string").coalesce(1)
    sam.write_bam(df, str(tmp_path / "x.bam"), [("chr1", 5000)])
    (path,) = [str(p) for p in sorted((tmp_path / "x.bam").iterdir()) if p.stat().st_size > 10_000] or [None]
    assert len(sam.BamReader([list(vars(f).values()) for f in sam.bam_files([path])], 20_000, sam.Region()).partitions()) > 4
    got = sam.read_bam(spark, [path], 20_000).orderBy("align_ordinal").collect()
    assert [(r.query_name, r.cr) for r in got] == [(r[0], r[8]) for r in rows] and len({r.align_ordinal for r in got}) == 3000
    with gzip.open(path) as f:  # the blocks are gzip members for any other reader
        assert f.read(4) == b"BAM\1"


def test_sam_order_of_lines(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tVN:1.6\n" + "".join(f"q{i}\t0\tr\t5\t9\t1M\t*\t0\t0\tA\tF\tCB:Z:c\n" for i in range(500)))
    rows = sam.read_sam(spark, str(tmp_path / "x.sam"))
    assert [r.query_name for r in rows.orderBy("align_ordinal").collect()] == [f"q{i}" for i in range(500)]


def test_whitelist_and_counters(spark, tmp_path):
    (tmp_path / "w.txt").write_bytes(gzip.compress(b"ACGT-1\nTTTT \n"))
    assert [r.barcode for r in lists.read_whitelist(spark, str(tmp_path / "w.txt")).collect()] == ["ACGT", "TTTT"]
    (tmp_path / "w.gz").write_bytes(b"AC-1\r\nGT\n")  # plain, whatever its name says
    assert [r.barcode for r in lists.read_whitelist(spark, str(tmp_path / "w.gz")).collect()] == ["AC", "GT"]
    (tmp_path / "e.txt").write_text("")
    with pytest.raises(ValueError, match="no barcodes"):
        lists.read_whitelist(spark, str(tmp_path / "e.txt"))
    lists.write_counters(spark.createDataFrame([("b", 1234567), ("a", 1)], "key string, n long"), str(tmp_path / "c"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "c").glob("part-*"))) == "a: 1\nb: 1,234,567\n"


def test_frequent_keys_are_dealt_and_joined_whole(spark):
    rows = spark.range(9000).select(F.when(F.col("id") < 5000, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")).unionByName(spark.createDataFrame([(None, 1)], "k long, v long"))
    one = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    got = split_join(rows, one, ["k"], "n")
    assert got.count() == 9000 and got.where("k = 1 AND m = 4999").count() == 5000


def free(a, b):
    d = list(range(len(b) + 1))
    best = min(len(a), len(b)) if not a or not b else 10**9
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(d[j - 1] + (x != y), d[j] + 1, new[-1] + 1))
        d = new
        best = min(best, d[-1])
    return min(best, *d)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_free_divergence_equals_the_plain_rule(spark, most):
    rng = random.Random(8)
    umis = sorted({"".join(rng.choice("AC") for _ in range(rng.randint(3, 7))) for _ in range(60)})
    counts = spark.createDataFrame([("r", "c", "g", "G", u, 1, i) for i, u in enumerate(umis)], "ref string, cb string, gx string, gn string, ur string, cnt long, ord long")
    got = {(r.a, r.b) for r in edges(counts, "freediv", most).collect()}
    assert got == {(a, b) for a in umis for b in umis if a < b and abs(len(a) - len(b)) <= most and free(a, b) <= most}


def test_parts_and_prefixes(tmp_path):
    (tmp_path / "name=x_1").mkdir()
    (tmp_path / "name=x_1" / "part-0.txt").write_text("")
    assert files.parts(str(tmp_path / "name=x_1")) == [str(tmp_path / "name=x_1" / "part-0.txt")] and files.prefix(str(tmp_path / "name=x_1")) == "x_1"


def test_a_run_leaves_a_whole_output_and_no_intermediates(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from cellweave.jobs import count as jobs
    from cellweave.session import shared_dir
    from cellweave.sources import output, simulate

    config = {"unknown_read_orientation": False, "barcode_struct_r1": STRUCT}
    made = simulate.simulated(spark, [STRUCT, STRUCT], 30, error=1e-9)
    fastq.write(made.withColumn("name", F.concat(F.lit("run_"), F.col("mate").cast("string"))), str(tmp_path / "reads"))
    shared = Path(shared_dir(spark).removeprefix("file:")) / "cellweave"
    before = set(shared.iterdir()) if shared.exists() else set()
    out = str(tmp_path / "out")

    def killed(*_):
        raise KeyboardInterrupt

    real = jobs.reads.format_tags
    monkeypatch.setattr(jobs.reads, "format_tags", killed)  # reads and counters are written by then
    with pytest.raises(KeyboardInterrupt):
        jobs.preprocess(spark, str(tmp_path / "reads"), config, out)
    monkeypatch.setattr(jobs.reads, "format_tags", real)
    with pytest.raises(FileNotFoundError, match="unfinished"):
        output.part(out, "tags")
    assert not [p for p in (tmp_path / "out").iterdir() if p.name != output.STAGED]
    assert jobs.preprocess(spark, str(tmp_path / "reads"), config, out).count() > 20
    assert {p.name for p in (tmp_path / "out").iterdir()} - {output.STAGED, ".crc"} >= {"reads", "tags", "tag-lines", "names", "counters", output.MANIFEST}
    with pytest.raises(FileExistsError):
        jobs.preprocess(spark, str(tmp_path / "reads"), config, out)
    # of two runs beside each other the later one fails, and changes nothing
    one = output.Output(spark, str(tmp_path / "two")).__enter__()
    spark.range(3).write.parquet(one.path("x"))
    with output.Output(spark, str(tmp_path / "two")) as other:
        spark.range(5).write.parquet(other.path("x"))
    with pytest.raises(FileExistsError):
        one.__exit__(None, None, None)
    assert spark.read.parquet(output.part(str(tmp_path / "two"), "x")).count() == 5
    with pytest.raises(FileNotFoundError, match="unfinished"):
        market.read(spark, str(tmp_path / "two"))
    assert (set(shared.iterdir()) if shared.exists() else set()) == before
