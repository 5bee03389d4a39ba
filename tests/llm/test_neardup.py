import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellweave.llm import neardup


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    holders, parent = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = Counter((a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[k + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.integers(len(words))] = f"x{rng.integers(40)}"
    return " ".join(words)


def test_equals_brute_force_on_edited_copies_and_odd_texts(spark):
    rng = np.random.default_rng(2)
    rows = [(i, edited(rng, [f"w{k}" for k in range(120)], rng.integers(0, 9))) for i in range(150)]
    rows += [(200 + i, " ".join(f"v{x}" for x in rng.integers(0, 500, 60))) for i in range(60)]
    rows += [(300, None), (301, ""), (302, "a b"), (303, "A\tB"), (304, " \n "), (305, "a b c"), (306, rows[160][1]), (307, rows[160][1].upper())]
    rows += [(400, " ".join(f"long{k % 977}" for k in range(20000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS component_id", "2 AS n")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_null_and_repeated_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect())
    assert got == [(False, 1, 1, True), (False, 1, 1, True), (False, 2, 1, False), (True, None, None, True)]
    assert neardup.near_duplicates(df.where("false")).collect() == []


@pytest.mark.parametrize("edges,want", [([(1, 2), (2, 3), (3, 4), (9, 8)], {2: 1, 3: 1, 4: 1, 9: 8}), ([(7, 7)], {})])
def test_components(spark, edges, want):
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.id: r.component for r in neardup.components(df).collect() if r.id != r.component} == want


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_keep_one_tells_rows_apart_by_text(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (2, "another text of six words here"), (3, None), (3, None), (None, "a b c d e f"), (None, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({}).selectExpr("*", "1 AS n", "2 AS component_id")
    got = sorted(map(repr, [(r.doc_id, r.text) for r in neardup.keep_one(spark, df).collect()]))
    assert got == sorted(map(repr, [(1, "a b c d e f"), (2, "another text of six words here"), (3, None), (3, None), (None, "a b c d e f"), (None, "a b c d e f")]))
