"""Periodic runs against a plain search, on fixtures with odd rows."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from cellweave.llm import periods

ODD = [None, "", " \n\t ", "one", "é ñ 日本 😀 " * 9, "a " * 3000, "same line\n" * 40, "x" * 50_000, "a b\x0bc\x0cd\re " * 12, "no break  wide " * 30, "x y " * 5 + "z " * 23, "a b c d e f g h " * 3]


def plain_runs(words):
    out = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def drawn(rng):
    letters = [f"w{k}" for k in range(rng.choice([1, 2, 3, 30]))]
    words = [rng.choice(letters) for _ in range(rng.choice([0, 5, 23, 24, 25, 60, 300]))]
    for _ in range(rng.randint(0, 4)):
        cycle = [rng.choice(letters) for _ in range(rng.randint(1, 20))]
        at = rng.randint(0, len(words))
        words[at:at] = (cycle * 9)[: rng.randint(1, 8 * len(cycle))]
    return " ".join(words)


def test_runs_are_those_of_a_plain_search():
    rng = random.Random(5)
    for _ in range(150):
        texts = [drawn(rng) for _ in range(rng.randint(1, 6))]
        for text, found in zip(texts, periods.find(texts)["runs"].to_pylist(), strict=True):
            assert [(r["start"], r["length"], r["period"]) for r in found] == plain_runs(text.split())


def test_the_grid_may_be_cut_anywhere(monkeypatch):
    monkeypatch.setattr(periods, "PAIRS", 7)
    texts = [drawn(random.Random(k)) for k in range(12)]
    assert [[tuple(r.values()) for r in x] for x in periods.find(texts)["runs"].to_pylist()] == [plain_runs(t.split()) for t in texts]


def test_common_lengths_through_the_cover():
    rng = np.random.default_rng(3)
    for letters, n in ((1, 400), (2, 700), (9, 300), (2, 5)):
        seq = np.append(rng.integers(0, letters, n), 99)
        seq[n // 2] = 98
        held = periods.Extensions(seq)
        i, j = rng.integers(0, len(seq), (2, 2000))
        i, j = i[i != j], j[i != j]
        want = [next((k for k in range(len(seq)) if max(a, b) + k >= len(seq) or seq[a + k] != seq[b + k]), len(seq)) for a, b in zip(i, j)]
        assert held.lengths(i, j).tolist() == want


@pytest.mark.parametrize("words,runs", [(["a"] * 400_000, 1), ([f"{k}" for k in range(300_000)], 0)], ids=["one word", "all different"])
def test_very_long_texts(words, runs):
    found = periods.find([" ".join(words), "b " * 24])["runs"].to_pylist()
    assert [len(x) for x in found] == [runs, 1]


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_query_on_odd_rows_and_drawn_texts(spark, tmp_path):
    rng = random.Random(8)
    data = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "a " * 30, "x", 1), (3, "one", "x", 1)] + [(100 + i, drawn(rng), None, 2) for i in range(200)]
    spark.createDataFrame(data, "doc_id long, text string, runs string, n_words int").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in periods.query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((contract(i, t) for i, t, *_ in data), key=str)
    none = spark.read.parquet(f"{tmp_path}/documents.parquet").where("false")
    assert periods.digests(periods.periodic_runs(periods.planted(none), keep=["doc_id"])).collect() == []


def test_query_on_the_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in periods.query(spark, folder).collect()]
    assert sorted(got) == sorted(contract(*d) for d in docs) and sum(g[1] for g in got) > 10
