"""Directional UMI clusters where first alignments share a position."""

import random

from cellweave.jobs.count import with_umis
from cellweave.operators import matrix, umi

COLUMNS = "read_no long, ref string, cb string, ur string, gx string, gn string, pos long, is_reverse boolean, is_paired boolean, is_read1 boolean, is_read2 boolean, mate_is_unmapped boolean"


def alignments(spark, rows):
    """``rows``: (UMI, position, is_reverse)."""
    made = [(i, "chr1", "AAAA", u, "g", "G", p, r, False, False, False, False) for i, (u, p, r) in enumerate(rows)]
    return spark.createDataFrame(made, COLUMNS)


def near(a, b):
    return len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) <= 1


def roots(rows):
    """The rule of the reference over UMIs in first-seen order."""
    seen = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    order = list(dict.fromkeys(u for u, _, _ in seen))
    count = {u: sum(r[0] == u for r in rows) for u in order}
    into: dict[str, list[str]] = {}
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if near(a, b):
                if count[a] >= 2 * count[b] - 1:
                    into.setdefault(b, []).append(a)
                elif count[b] >= 2 * count[a] - 1:
                    into.setdefault(a, []).append(b)
    rank = {u: (-count[u], i) for i, u in enumerate(order)}
    parent = {u: min(found, key=rank.get) for u, found in into.items()}
    out = {}
    for u in order:
        at = u
        while at in parent:
            at = parent[at]
        out[u] = at
    return out


def test_umis_at_one_position_merge(spark):
    rows = alignments(spark, [("ACGT", 7, False), ("ACGA", 7, False), ("TTTT", 7, False)])
    done = with_umis(rows)
    assert {(r.ur, r.ub) for r in done.select("ur", "ub").collect()} == {("ACGA", "ACGA"), ("ACGT", "ACGA"), ("TTTT", "TTTT")}
    assert [(r.n_reads, r.n_umis) for r in matrix.umi_matrix(done).collect()] == [(3, 2)]


def test_the_forward_strand_comes_first(spark):
    found = umi.corrected(umi.umi_counts(alignments(spark, [("ACGA", 7, True), ("ACGT", 7, False)])), "hamming")
    assert {(r.ur, r.ub) for r in found.collect()} == {("ACGA", "ACGT"), ("ACGT", "ACGT")}


def test_an_ordinal_decides_when_there_is_one(spark):
    rows = alignments(spark, [("ACGT", 7, False), ("ACGA", 7, False)]).withColumnRenamed("read_no", "align_ordinal")
    assert {(r.ur, r.ub) for r in umi.corrected(umi.umi_counts(rows)).collect()} == {("ACGA", "ACGT"), ("ACGT", "ACGT")}


def test_ties_equal_the_plain_rule(spark):
    rng = random.Random(6)
    rows = [("".join(rng.choice("ACGT") for _ in range(4)), rng.randrange(3), rng.random() < 0.5) for _ in range(150)]
    found = umi.corrected(umi.umi_counts(alignments(spark, rows).repartition(7)), "hamming")
    assert {r.ur: r.ub for r in found.collect()} == roots(rows)


def test_a_umi_of_very_many_reads_is_dealt_over_tasks(spark, monkeypatch):
    from cellweave.operators import skew

    monkeypatch.setattr(skew, "SPLIT", 50)
    rows = alignments(spark, [("ACGT", 7, False)] * 400 + [("ACGA", 8, False), (None, 9, False), ("TTTT", 9, True)])
    done = with_umis(rows)
    assert sorted((r.ur or "", r.ub or "", r["count"]) for r in done.groupBy("ur", "ub").count().collect()) == [("", "", 1), ("ACGA", "ACGT", 1), ("ACGT", "ACGT", 400), ("TTTT", "TTTT", 1)]
    assert set(done.columns) == {*rows.columns, "ub"}


def test_few_corrected_umis_are_sent_to_the_alignments(spark, monkeypatch):
    rows = alignments(spark, [("ACGT", 7, False)] * 400 + [("ACGA", 8, False), (None, 9, False), ("TTTT", 9, True)]).localCheckpoint()
    mapping = umi.corrected(umi.umi_counts(rows), counted=True)
    sent = umi.apply(rows, mapping)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    want = sorted(map(tuple, sent.select("ur", "pos", "ub").collect()), key=repr)
    monkeypatch.setattr(umi, "SENT", 0)
    assert sorted(map(tuple, umi.apply(rows, mapping).select("ur", "pos", "ub").collect()), key=repr) == want and (None, 9, None) in want


def test_features_of_lists(spark):
    from cellweave.functions.sequences import features

    rows = spark.createDataFrame([("a;b", "A;B;C"), ("a", "A"), ("a;b", "A"), (None, "A"), ("a", None), ("", "A"), ("a;", "A;B")], "gx string, gn string")
    got = [[(f["gx"], f["gn"]) for f in r["f"]] for r in rows.select(features(rows["gx"], rows["gn"]).alias("f")).collect()]
    assert got == [[("a", "A"), ("b", "B")], [("a", "A")], [("a", "A")], [], [], [("", "A")], [("a", "A"), ("", "B")]]
