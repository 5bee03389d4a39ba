"""BAM records without loss, shares, index and regions; first reads alone; order over several files."""

import gzip
import io
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.jobs.count import barcode_mate, count, load_alignments, name_positions
from cellweave.operators import umi
from cellweave.operators.extract import Layout
from cellweave.sources import alignments as sam
from cellweave.sources import bam, bgzf, fastq, files

REFS = [("chr1", 500_000), ("chr2", 90_000), ("chrM", 16_000)]
SHOWN = [*bam.SCHEMA.names[:-1], "tags", "gx", "cb", "ur", "fl", "is_reverse", "is_paired"]


def tag(name, kind, value):
    if kind in "ZH":
        return name.encode() + kind.encode() + value.encode() + b"\0"
    if kind == "A":
        return name.encode() + b"A" + value.encode()
    if kind == "B":
        sub, *rest = value.split(",")
        return name.encode() + b"B" + sub.encode() + struct.pack(f"<i{len(rest)}{ {'c': 'b', 'S': 'H', 'f': 'f', 'I': 'I'}[sub]}", len(rest), *(float(x) if sub == "f" else int(x) for x in rest))
    return name.encode() + kind.encode() + struct.pack("<" + {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}[kind], float(value) if kind == "f" else int(value))


def drawn(n, seed=1):
    """Records of all kinds as (fields, tags), in coordinate order, unmapped ones last."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 7, 10, 31])
        mapped = rng.random() < 0.9
        tags = [("GX", "Z", f"g{i % 5}"), ("NM", "C", str(i % 200)), ("AS", "s", str(-i)), ("XA", "A", "q"), ("XF", "f", str(np.float32(rng.random()))), ("XB", "B", "S,1,65535"), ("XC", "B", "f,0.5,-2.25"), ("XI", "I", "4000000000"), ("XH", "H", "1AFF"), ("CB", "Z", "AC"), ("FL", "i", "11")]
        rng.shuffle(tags)
        ref = rng.randrange(3) if mapped else -1
        out.append([(ref if mapped else 9, rng.randrange(REFS[ref][1] - 100) if mapped else -1), f"q{i:05d}", (rng.choice([0, 16, 1 | 64, 1 | 128 | 8]) if mapped else 4), rng.randrange(60), ref,
                    [(size, 0)] if size and mapped else [], rng.choice([-1, 0, 1, 2]), rng.randrange(9000), rng.randrange(-500, 500), "".join(rng.choice("ACGTN") for _ in range(size)), rng.random() < 0.8, tags[: rng.randrange(len(tags) + 1)]])
    return sorted(out, key=lambda r: r[0])


def packed(records):
    head = b"BAM\1" + struct.pack("<i", 5) + b"@HD\t\n" + struct.pack("<i", 3) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", x) for n, x in REFS)
    out = [head]
    for (_, pos), name, flag, mapq, ref, steps, mate, mate_pos, span, seq, rated, tags in records:
        codes = [bam.BASES.index(c) for c in seq] + [0] * (len(seq) % 2)
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(steps), flag, len(seq), mate, mate_pos if mate >= 0 else -1, span) + name.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | k) for n, k in steps) + bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2])) + (bytes(len(name) + k for k in range(len(seq))) if rated else b"\xff" * len(seq))
        body += b"".join(tag(*t) for t in tags)
        out.append(struct.pack("<i", len(body)) + body)
    return b"".join(out)


def blocked(data, size=3000):
    return b"".join(bgzf.compressed(data[i : i + size]) for i in range(0, len(data), size)) + bgzf.compressed(b"")


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    out = tmp_path_factory.mktemp("bam") / "x.bam"
    out.write_bytes(blocked(packed(drawn(1500))))
    return str(out)


def rows_of(df):
    return sorted((tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.select(*SHOWN).collect()), key=str)


def test_every_field_and_tag_survives(spark, path, tmp_path):
    given = sam.read_bam(spark, [path], unmapped=True)
    want = {(r[1], (tuple(f"{n}:{k}:{v}" for n, k, v in r[-1] if n not in ("GX", "CB", "FL")))) for r in drawn(1500)}
    assert {(r.query_name, tuple(r.tags)) for r in given.collect()} == want
    sam.write_bam(given, str(tmp_path / "again.bam"), REFS)
    again = sam.read_bam(spark, [str(tmp_path / "again.bam")], unmapped=True)
    assert rows_of(again) == rows_of(given) and given.count() == 1500
    assert sam.read_bam(spark, [path]).count() == sum(r[4] >= 0 for r in drawn(1500))
    sam.write_sam(given, str(tmp_path / "text"), REFS)
    text = sam.read_sam(spark, str(tmp_path / "text"), unmapped=True)
    plain = lambda df: df.withColumn("tags", F.transform("tags", lambda t: F.regexp_replace(t, "^(..):[cCsSI]:", "$1:i:")))
    assert rows_of(text) == rows_of(plain(given))


def test_a_file_gzipped_as_one_is_read_too(spark, path, tmp_path):
    (tmp_path / "y.bam").write_bytes(gzip.compress(packed(drawn(1500))))
    assert rows_of(sam.read_bam(spark, [str(tmp_path / "y.bam")], 4000, True)) == rows_of(sam.read_bam(spark, [path], unmapped=True))


def read_by(path, share, region=sam.Region(), indexed=False):
    (file,) = sam.bam_files([path])
    file = sam.BamFile(file.path, file.size, 0, 0, indexed)
    return [r for at in range(0, file.size, share) for b in sam.share_of(file, at, share, region) for r in b.to_pylist()]


@pytest.mark.parametrize("share", [700, 5_000, 33_333, 1 << 20])
def test_shares_hold_each_record_once_in_order(path, share):
    got = read_by(path, share)
    assert [r["query_name"] for r in got] == [r[1] for r in drawn(1500)]
    places = [r["align_ordinal"]["place"] for r in got]
    assert places == sorted(set(places))


def test_records_longer_than_shares(tmp_path):
    rng = random.Random(3)
    records = [[(0, i), f"q{i}", 0, 9, 0, [], -1, 0, 0, "".join(rng.choice("ACGT") for _ in range(rng.choice([5, 9000]))), True, []] for i in range(60)]
    (tmp_path / "x.bam").write_bytes(blocked(packed([[*r[:9], r[9], False, r[11]] for r in records]), 2000))
    for share in (900, 4000, 50_000):
        assert [r["seq"] for r in read_by(str(tmp_path / "x.bam"), share)] == [r[9] for r in records]


def test_an_index_opens_only_blocks_of_the_region(spark, path, tmp_path, monkeypatch):
    sam.write_bam(sam.read_bam(spark, [path], unmapped=True).repartition(1), str(tmp_path / "s.bam"), REFS)
    monkeypatch.setattr(bgzf, "FULL", 1500)
    part = next(p for p in sorted((tmp_path / "s.bam").glob("part-*.bam")) if p.stat().st_size > 1000)
    # written again in small blocks, so that regions are some blocks of many
    out, (file,) = io.BytesIO(), sam.bam_files([str(part)])
    made = sam._Blocks(out, bam.Index(3), packed([]))
    for batch in sam.share_of(file, 0, 1 << 30, sam.Region()):
        table = batch.drop_columns(["align_ordinal", "path_no"])
        for low in range(0, table.num_rows, 37):
            made.add(*bam.encoded(table.slice(low, 37), [n for n, _ in REFS]))
    index = made.close()
    (tmp_path / "i.bam").write_bytes(out.getvalue())
    (tmp_path / "i.bam.bai").write_bytes(index)
    every = read_by(str(tmp_path / "i.bam"), 1 << 30)
    opened = []
    real = bgzf.blocks
    monkeypatch.setattr(bgzf, "blocks", lambda raw, at: (opened.append(x[0]) or x for x in real(raw, at)))
    for ref, begin, end in (("chr1", 100_000, 140_000), ("chr2", 0, sam.FAR), ("chrM", 15_000, 15_900), ("none", 0, sam.FAR)):
        for share in (4000, 1 << 30):
            del opened[:]
            got = read_by(str(tmp_path / "i.bam"), share, sam.Region((ref,), begin, end), True)
            hit = lambda rows: [r["query_name"] for r in rows if r["ref"] == ref and begin <= r["pos"] < end]
            assert hit(got) == hit(every) and len(got) <= len(hit(every)) + 450
            n = len(real_blocks := {x for x in opened})
            assert n < 0.75 * len(list(real(io.BufferedReader(io.BytesIO(out.getvalue())), 0))), real_blocks


def test_a_region_leaves_out_parts(spark, path, tmp_path):
    rows = sam.read_bam(spark, [path]).withColumns({"ref": F.lit("chr1"), "pos": F.abs(F.hash("query_name")) % 400_000})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sam.write_bam(rows, str(tmp_path / "p.bam"), REFS)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    listed = [list(vars(f).values()) for f in sam.bam_files([str(tmp_path / "p.bam")])]
    whole = sam.BamReader(listed, 1 << 30, sam.Region()).partitions()
    assert len(whole) > 2

    def planned(*region):
        return [p for p in sam.BamReader(listed, 1 << 30, sam.Region(*region)).partitions() if p.value]

    assert len(planned(("chr2",))) == 0 and len(planned(("chr1", "chr2"))) == len(whole)
    assert 1 <= len(planned(None, 1000, 20_000)) < len(whole)
    some = sam.read_bam(spark, [str(tmp_path / "p.bam")], region=sam.Region(("chr1",), 1000, 20_000))
    assert some.rdd.getNumPartitions() < len(whole) and some.count() == rows.where("pos >= 1000 AND pos < 20000").count()
    assert sam.read_bam(spark, [str(tmp_path / "p.bam")], region=sam.Region(("chr2",))).count() == 0


def test_a_part_without_places_is_read(spark, path, tmp_path):
    """Of records without a place a part of their own is made where they are many."""
    loose = sam.read_bam(spark, [path], unmapped=True).where("ref = '*'")
    sam.write_bam(loose, str(tmp_path / "loose.bam"), REFS)
    assert {r for f in sam.bam_files([str(tmp_path / "loose.bam")]) for r, _, _ in f.spans} == {"*"}
    assert rows_of(sam.read_bam(spark, [str(tmp_path / "loose.bam")], unmapped=True)) == rows_of(loose) != []
    assert sam.read_bam(spark, [str(tmp_path / "loose.bam")], unmapped=True, region=sam.Region(("chr1",))).count() == 0


def test_a_killed_run_leaves_nothing_that_reads_as_whole(spark, path, tmp_path):
    bad = sam.read_bam(spark, [path]).withColumn("ref", F.when(F.col("query_name") == "q00700", "other").otherwise(F.col("ref")))
    with pytest.raises(Exception, match="other"):
        sam.write_bam(bad, str(tmp_path / "k.bam"), REFS)
    with pytest.raises(ValueError, match="unfinished"):
        sam.read_bam(spark, [str(tmp_path / "k.bam")])
    sam.write_bam(sam.read_bam(spark, [path]).where("false"), str(tmp_path / "none.bam"), REFS)
    assert sam.read_bam(spark, [str(tmp_path / "none.bam")]).count() == 0


# ---------------------------------------------------------------- order over files


@pytest.mark.parametrize("kind", ["bam", "sam", "parquet"])
def test_umis_of_a_later_file_come_later(spark, tmp_path, kind):
    def record(name):
        return (name, 0, "chr1", 5, 255, "5M", "ACGTA", "FFFFF", "g", "G")

    columns = "query_name string, flag int, ref string, pos long, mapq int, cigar string, seq string, qual string, gx string, gn string"
    # the first file, whose name sorts last, holds ACGT behind another record
    paths = [str(tmp_path / f"{n}.{kind}") for n in ("z", "a")]
    for path, names in zip(paths, (["r0", "r1"], ["r2"]), strict=True):
        rows = spark.createDataFrame([record(n) for n in names], columns).coalesce(1)
        if kind == "bam":
            sam.write_bam(rows, path, REFS)
        elif kind == "sam":
            rows.select(F.concat_ws("\t", "query_name", F.lit("0\tchr1\t6\t255\t5M\t*\t0\t0\tACGTA\tFFFFF\tGX:Z:g\tGN:Z:G"))).coalesce(1).write.text(path)
        else:
            rows.withColumns({"is_reverse": F.lit(False), "is_paired": F.lit(False), "is_read1": F.lit(False), "is_read2": F.lit(False), "mate_is_unmapped": F.lit(False), "align_ordinal": F.monotonically_increasing_id()}).write.parquet(path)
    tags = spark.createDataFrame([("r0", "C", "C", "TTTT", 3), ("r1", "C", "C", "ACGT", 3), ("r2", "C", "C", "ACGA", 3)], "read_id string, cb string, cr string, ur string, fl int")
    done = count(load_alignments(spark, paths), tags, [], str(tmp_path / "out"))
    assert {r.ur: r.ub for r in done.collect()} == {"TTTT": "TTTT", "ACGT": "ACGT", "ACGA": "ACGT"}
    assert umi.PLACE[-1] in done.columns


# ---------------------------------------------------------------- reads


def read_text(n, seed=5):
    rng = random.Random(seed)
    rows = [(f"r{i}/1 @x", "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 40)))) for i in range(n)]
    return rows, "".join(f"@{t}\n{s}\n+\n{'@' + 'F' * (len(s) - 1)}\n" for t, s in rows).encode()


@pytest.mark.parametrize("block,share", [(500, 1), (500, 400), (3000, 1000), (700, 5000), (20_000, 1 << 20)])
def test_reads_gzipped_in_blocks_are_split(spark, tmp_path, block, share):
    rows, text = read_text(400)
    (tmp_path / "x_1.fq").write_bytes(blocked(text, block))
    (tmp_path / "x_2.fq.gz").write_bytes(text)  # plain, whatever its name says
    size = (tmp_path / "x_1.fq").stat().st_size
    found = [list(fastq._of_share(str(tmp_path / "x_1.fq"), at, min(at + share, size), size)) for at in range(0, size, max(share, 37))] if share > 1 else [list(fastq._of_share(str(tmp_path / "x_1.fq"), at, at + 1, size)) for at in range(size)]
    assert [(t, s) for part in found for t, s, _ in part] == rows
    if share == 1000:
        assert sum(bool(part) for part in found) >= 3
        read = fastq.read(spark, files.paired(str(tmp_path)), share).orderBy("mate", "rec_idx").collect()
        assert [(r.mate, r.rec_idx, r.description, r.seq) for r in read] == [(m, i, t, s) for m in (1, 2) for i, (t, s) in enumerate(rows)]


def test_small_shares_are_read_by_few_tasks(spark, tmp_path, monkeypatch):
    """Shares begin and end inside records, but a task, and a file opened, is for a run of them."""
    rows, text = read_text(3000)
    for name in ("a_1.fq", "a_2.fq"):
        (tmp_path / name).write_bytes(text)
    read = fastq.Reads(spark, files.paired(str(tmp_path)), 500)
    assert len(read.shares) > 400 and read.rows().rdd.getNumPartitions() == 2
    got = read.rows().orderBy("mate", "rec_idx").collect()
    assert [(r.mate, r.rec_idx, r.description, r.seq) for r in got] == [(m, i, t, s) for m in (1, 2) for i, (t, s) in enumerate(rows)]
    assert read.rows(mate=2, last=1000).agg(F.count("*"), F.max("rec_idx")).first() == (1001, 1000)
    monkeypatch.setattr(fastq, "RUN", 5_000)
    assert read.rows().rdd.getNumPartitions() > 40 and read.rows().orderBy("mate", "rec_idx").collect() == got


def test_first_reads_open_first_shares_alone(spark, tmp_path):
    rows, text = read_text(3000)
    for name in ("a_1.fq", "a_2.fq", "b_1.fq", "b_2.fq"):
        (tmp_path / name).write_bytes(text)
    read = fastq.Reads(spark, files.paired(str(tmp_path)), 10_000)
    n = len(read.shares)
    assert n > 40 and len(read.planned(pair=0, last=250)) < n / 8 and len(read.planned(mate=2)) == n / 2 and not read.planned(pair=7)
    assert len(read.planned(last=0)) == 4
    assert read.rows(pair=0, last=500).rdd.getNumPartitions() < n / 4 and read.rows(pair=0, last=500).count() == 1002
    assert read.rows(last=0).count() == 4 and read.rows().count() == 12_000 and read.rows(pair=7).count() == 0
    assert name_positions(read) == {0: [], 1: []}
    assert barcode_mate(read, Layout.of({"blocks": [{"blocktype": "barcodeList", "blockfunction": "cellBarcode", "sequence": ["ACGT"], "maxerrors": 1}, {"blocktype": "constantRegion", "blockfunction": "x", "sequence": ["GATTACA"], "maxerrors": 1}]}), False) == 2
