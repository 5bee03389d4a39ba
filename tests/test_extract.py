"""The alignment kernel against a scalar one, and extraction on reads whose parts are known."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellweave.functions import alignment
from cellweave.functions.alignment import align, boundaries, encoded
from cellweave.operators import extract as extract_module
from cellweave.operators.extract import Block, Layout, aligned, extract


def scalar(template, read):
    n, m = len(template), len(read)
    s = [[0] * (m + 1) for _ in range(n + 1)]
    for i, j in itertools.product(range(n + 1), range(m + 1)):
        if i == 0 or j == 0:
            s[i][j] = -19 * (i + j)
            continue
        x, y = template[i - 1], read[j - 1]
        pair = 0 if "N" in (x, y) else 10 if x == y else -10
        s[i][j] = max(s[i - 1][j - 1] + pair, s[i - 1][j] - 11, s[i][j - 1] - (0 if i == n else 11))
    return s[n][m]


def test_scores_and_paths():
    rng = random.Random(3)
    cases = [("".join(rng.choices("ACGTN", k=7)), "".join(rng.choices("ACGTN", k=rng.randrange(12)))) for _ in range(500)]
    reads, lengths = encoded([r for _, r in cases])
    scores, used = align(encoded([t for t, _ in cases])[0], reads, lengths)
    assert [scalar(t, r) for t, r in cases] == scores.tolist()
    for (template, read), score, path in zip(cases, scores, used, strict=True):
        total, j, n = 0, 0, len(template)
        for i, u in enumerate(path):
            if u < 0:
                total -= 19 if j == 0 else 11
                continue
            total -= (u - 1 - j) * (19 if i == 0 else 11)
            x, y = template[i], read[u - 1]
            total += 0 if "N" in (x, y) else 10 if x == y else -10
            j = u
        if (path >= 0).all():
            assert total == score


@pytest.mark.parametrize(("used", "ends", "want", "ok"), [
    ([1, 2, 3, 4], [2, 4], [2, 4], True),
    ([1, 2, 4, 5], [2, 4], [2, 5], True),  # a letter inserted at the boundary goes to the next block
    ([1, -1, -1, 2], [2, 4], [1, 2], True),  # inside a gap: where the pairs before it end
    ([1, -1, 3, 4], [2, 4], [2, 4], True),  # a run starts at the boundary
    ([1, 2, -1, -1], [2, 4], [2, 4], True),  # the end is carried on past the last pair
    ([-1, -1, -1, 1], [2, 4], None, False),
    ([1, -1, -1, -1], [2, 4], None, False),
    ([-1, -1, -1, -1], [2, 4], None, False),
])
def test_boundaries(used, ends, want, ok):
    out, good = boundaries(np.array([used]), ends)
    assert bool(good[0]) is ok
    if ok:
        assert out[0].tolist() == want


FIRST, SECOND, CONSTANTS = ("AACCGGTT", "CCTTAAGG", "GGAATTCC", "TTGGCCAA"), ("ACACACAC", "GTGTGTGT", "CAGTCAGT"), ("GATTACAGATC", "GATTACAGATCT")
LAYOUT = Layout((
    Block("barcodeList", "cellBarcode", FIRST), Block("constantRegion", "linker", CONSTANTS),
    Block("barcodeList", "cellBarcode", SECOND), Block("randomBarcode", "UMI", length=8),
))


def test_extract(spark):
    tail = "GGGTTTAAACCCGGGTTT"
    rows = [
        (1, FIRST[0] + CONSTANTS[0] + SECOND[0] + "TTACGGCA" + tail),
        (2, FIRST[1] + CONSTANTS[1] + SECOND[1] + "CATTGCCA" + tail),
        (3, "AACCGGTA" + CONSTANTS[0] + SECOND[2] + "TGCATGAA" + tail),
        (4, "T" * 60), (5, ""), (6, None), (6, None),
    ]
    got = {r.name: r for r in extract(spark.createDataFrame(rows, "name int, seq string"), LAYOUT).collect()}
    assert (got[1].cb, got[1].cr, got[1].ur, got[1].fl, got[1].trimmed) == ("AACCGGTT.ACACACAC", "AACCGGTT.ACACACAC", "TTACGGCA", 11, tail)
    assert (got[2].cb, got[2].ur, got[2].fl, got[2].trimmed) == ("CCTTAAGG.GTGTGTGT", "CATTGCCA", 12, tail)
    assert (got[3].cb, got[3].cr, got[3].ur) == ("AACCGGTT.CAGTCAGT", "AACCGGTA.CAGTCAGT", "TGCATGAA")
    for i in (4, 5, 6):
        assert got[i].cb is None and got[i].trimmed is None and got[i].score < got[1].score


def test_other_strand(spark):
    read = FIRST[0] + CONSTANTS[0] + SECOND[0] + "TTACGGCA" + "GGGTTT"
    turned = read[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = spark.createDataFrame([(1, read), (2, turned)], "name int, seq string")
    assert {r.oriented for r in aligned(rows, LAYOUT, either_strand=True).collect()} == {read}
    empty = extract(rows.limit(0), LAYOUT, either_strand=True)
    assert empty.count() == 0 and "cb" in empty.columns


def test_layout():
    assert [LAYOUT.distance(i) for i in LAYOUT.places("barcodeList")] == ["levenshtein", "freediv"]
    with pytest.raises(ValueError, match="two blocks"):
        Layout(LAYOUT.blocks[:1])


def test_the_band_changes_nothing():
    rng = np.random.default_rng(4)
    for size in (14, 25, 33):
        made = rng.choice(list(b"ACGTN"), (300, size)).astype(np.uint8)
        texts = []
        for t in made:
            s = [chr(c) if c != 78 else "ACGT"[rng.integers(4)] for c in t]
            for _ in range(rng.integers(0, 9)):
                at = rng.integers(0, max(1, len(s)))
                s[at : at + rng.integers(0, 4)] = list("ACGT"[: rng.integers(0, 4)])
            texts.append("".join(s) + "ACGTTGCA" * 3 if rng.random() < 0.9 else "".join(rng.choice(list("ACGT"), rng.integers(0, 40))))
        letters, lengths = alignment.encoded(texts, int(1.5 * size))
        scores, used = alignment.align(made, letters, lengths)
        whole, all_used = alignment._aligned(made, letters, lengths, 99)
        assert (scores == whole).all() and (used == all_used).all()
        within = alignment._aligned(made, letters, lengths, alignment.BAND)[0]
        assert (within <= whole).all() and (within == whole).any()


def test_the_whole_matrix_is_for_variants_that_may_win(spark, monkeypatch):
    """Of two constants one at most fits, so the other's alignment is not looked for far from the diagonal."""
    rows = [(i, FIRST[i % 4] + CONSTANTS[0] + SECOND[i % 3] + "TTACGGCA" + "GGGTTTAAACCCGGGTTT") for i in range(40)]
    far = Layout((LAYOUT.blocks[0], Block("constantRegion", "linker", (CONSTANTS[0], "CCGTTGGACCATG")), *LAYOUT.blocks[2:]))
    widened = []

    class Frame:
        columns, schema = [], []

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    monkeypatch.setattr(extract_module, "_spread", lambda reads: Frame())
    monkeypatch.setattr(extract_module, "widened", lambda *given: widened.append(int(given[-1].sum())))
    batch = pa.RecordBatch.from_arrays([pa.array([[s] for _, s in rows], pa.list_(pa.string()))], names=["_strands"])
    (got,) = aligned(spark.range(0), far)([batch])
    assert sum(widened) == 0 and set(got.column("variant").to_pylist()) == {0} and all(got.column("aligned").to_pylist())


def test_reads_of_a_small_file_are_dealt_out(spark, tmp_path):
    """A file's columns may pack many reads: how many tasks align them does not hang on the file's parts."""
    spark.range(50).select(F.lit("ACGT").alias("seq")).coalesce(1).write.parquet(str(tmp_path / "few"))
    one = spark.read.parquet(str(tmp_path / "few"))
    wide = one.select("seq", *(F.repeat("seq", F.lit(1000)).alias(f"c{i}") for i in range(200)))
    monster = extract_module.FEW
    try:
        extract_module.FEW = 10
        dealt = extract_module._spread(wide)
        assert dealt.rdd.getNumPartitions() > one.rdd.getNumPartitions()
    finally:
        extract_module.FEW = monster


def test_pieces_too_many_to_send_decode_alike(spark, monkeypatch):
    rows = spark.createDataFrame([(i, FIRST[i % 4][:7] + "ACGT"[i % 3] + CONSTANTS[i % 2] + SECOND[i % 3] + "TTACGGCA" + "GGGTTTAAACCC") for i in range(60)], "name int, seq string")
    sent = sorted(map(tuple, extract(rows, LAYOUT).collect()), key=repr)
    monkeypatch.setattr(extract_module, "SENT", 0)
    assert sorted(map(tuple, extract(rows, LAYOUT).collect()), key=repr) == sent


def test_reads_without_gaps_are_not_aligned_in_a_matrix(spark, monkeypatch):
    """Reads whose constants lie at their own places, a letter exchanged or not, are settled letter by letter."""
    rng = np.random.default_rng(5)
    texts = [FIRST[i % 4] + CONSTANTS[0] + SECOND[i % 3] + "TTACGGCA" + "".join(rng.choice(list("ACGT"), 18)) for i in range(40)]
    filled = []
    monkeypatch.setattr(alignment, "_aligned", lambda *given: filled.append(len(given[2])) or pytest.fail("a matrix is filled"))
    size = len(texts[0]) - 18
    letters, lengths = alignment.encoded(texts, int(1.5 * size))
    made = alignment.encoded(["N" * len(FIRST[0]) + CONSTANTS[0] + "N" * (size - len(FIRST[0]) - len(CONSTANTS[0]))] * 40)[0]
    scores, used = alignment.align(made, letters, lengths)
    assert not filled and set(scores.tolist()) == {10 * len(CONSTANTS[0])} and (used == np.arange(1, size + 1)).all()


def test_no_way_with_gaps_scores_more_than_is_foretold():
    rng = np.random.default_rng(6)
    for size in (9, 25):
        made = rng.choice(list(b"ACGTN"), (500, size)).astype(np.uint8)
        texts = []
        for t in made:
            s = [chr(c) if c != 78 or rng.random() < 0.1 else "ACGT"[rng.integers(4)] for c in t]
            for _ in range(rng.integers(0, 4)):
                at = rng.integers(0, max(1, len(s)))
                s[at : at + rng.integers(0, 2)] = list("ACGTN"[: rng.integers(0, 3)])
            texts.append("".join(s) + "ACGTTGCA"[: rng.integers(0, 9)])
        letters, lengths = alignment.encoded(texts, int(1.5 * size))
        scores, most = alignment.upright(made, letters, lengths)
        whole, used = alignment._aligned(made, letters, lengths, 99)
        assert (whole <= np.maximum(scores, most)).all() and (scores <= whole).all()
        sure = scores > most
        assert sure.any() and (whole[sure] == scores[sure]).all() and (used[sure] == np.arange(1, size + 1)).all()


def test_letters_are_encoded_alike_whatever_their_lengths():
    for texts in (["ACGT", "TTTT"], ["ACGT", "", "TTé€A"], ["", ""], []):
        for width in (None, 2, 9):
            got, lengths = alignment.encoded(texts, width)
            raw = [t.encode("latin-1", "replace")[:width] for t in texts]
            assert lengths.tolist() == [len(r) for r in raw]
            assert [bytes(g) for g in got] == [r.ljust(got.shape[1], b"\0") for r in raw]
