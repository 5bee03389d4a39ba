"""Clustering and exact search of vectors against plain versions, on fixtures with odd rows."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from cellweave.llm import centroids, pivots, registry

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, cluster int, v string"


def rows(n, width, seed, lumps=0):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(max(1, lumps))]
    return [(i, [float(np.float32(b + rng.gauss(0, 0.05 if lumps else 1))) for b in base[i % len(base)]], 1, "x") for i in range(n)]


def odd(n, width, seed):
    """Copies, rows of one id, rows without id, nulls, other widths, zeros."""
    out = rows(n, width, seed)
    out += [out[3]] * 4 + [(i, out[5][1], 0, None) for i in range(n, n + 30)] + [(7, out[8][1], 0, "y"), (None, out[9][1], 0, "y"), (50, out[2][1], 0, "y")]
    out += [(n + 50 + i, v, 0, "z") for i, v in enumerate([None, [], [None] * width, [NAN] * width, [1.0] * (width - 1) + [INF], [0.5] * (width + 1), [0.25] * (width + 1), [0.0] * width])]
    return out


def plain_clusters(data):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in data if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None) + sorted(("~", q) for i, q in kept if i is None)
    at = [q for _, q in hashed[:8]]
    d = lambda q, c: sum((a - b) ** 2 for a, b in zip(q, c))
    for turn in range(11):
        best = [min((d(q, c), k) for k, c in enumerate(at)) for _, q in kept]
        if turn < 10:
            for k in range(len(at)):
                own = [q for (_, q), b in zip(kept, best) if b[1] == k]
                if own:
                    at[k] = [sum(x) // len(own) for x in zip(*own)]
    total = {k: sum(b[0] for b in best if b[1] == k) for k in range(len(at))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return [(i, k, x, total[k], sum(total.values()), digest[k]) for (i, _), (x, k) in zip(kept, best)]


def answered(spark, tmp_path, name, data):
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    return [tuple(r) for r in registry.QUERIES[name](spark, str(tmp_path)).collect()]


def ordered(found):
    return sorted(found, key=str)


@pytest.mark.parametrize("data", [odd(150, 64, 1), rows(5, 64, 2), rows(120, 64, 3, lumps=5), [(i, [1.0] * 64, 0, "") for i in range(20)], rows(1, 64, 4), []], ids=["odd", "few", "lumps", "equal", "one", "none"])
def test_clusters_are_those_of_plain_comparison(spark, tmp_path, data):
    assert ordered(answered(spark, tmp_path, "op11_orchard_clusters", data)) == ordered(plain_clusters(data))


def test_walks_compare_few_centroids_and_find_the_nearest():
    rng = np.random.default_rng(2)
    at = rng.integers(-5000, 5000, (40, 64))
    x = at[rng.integers(0, 40, 500)] + rng.integers(-300, 300, (500, 64))
    x[:40] = at
    held = centroids.Centroids(at.tolist())
    want = ((x[:, None] - at[None]) ** 2).sum(-1)
    got, d = held.nearest(x, rng.integers(0, 40, 500))
    assert (got == want.argmin(1)).all() and (d == want.min(1)).all()
    far = x.copy()
    far[:, 0] = 1 << 40  # squared distances beyond 64 bits
    got, d = held.nearest(far, np.zeros(500, np.int64))
    plain = ((far[:, None].astype(object) - at[None].astype(object)) ** 2).sum(-1)
    assert d.tolist() == plain.min(1).tolist() and got.tolist() == [p.tolist().index(min(p)) for p in plain]


def test_a_distance_beyond_a_long_is_the_largest_long(spark):
    data = [(i, [float(i)] * 63 + [3e38 if i == 4 else 0.0], 0, "") for i in range(12)]
    found, at = centroids.cluster(spark.createDataFrame(data, SCHEMA))
    assert found.count() == 12 and len(at) == 8 and found.agg({"distance": "max"}).first()[0] <= centroids.MOST


def plain_top(data):
    held = sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v, *_ in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, q in held:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in held if j != i and len(c) == len(q))
            out += [(i, k, j, -s) for k, (s, j) in enumerate(scores[:5], 1)]
    return out


@pytest.mark.parametrize("data", [odd(400, 16, 1), rows(3, 8, 2), rows(700, 24, 3, lumps=9), [(i, [1.0] * 4, 0, "") for i in range(120)], [(0, [1.0], 0, "")], rows(40, 8, 5)[1:], []], ids=["odd", "few", "lumps", "equal", "alone", "no query", "none"])
def test_top_k_is_that_of_all_products(spark, tmp_path, monkeypatch, data):
    for name, value in (("BLOCK", 60), ("RING", 16), ("GROUP", 4), ("PAGE", 5), ("FIRST", 1), ("MORE", 2)):
        monkeypatch.setattr(pivots, name, value)
    assert ordered(answered(spark, tmp_path, "op12_pivot_top_k", data)) == ordered(plain_top(data))


def test_products_are_exact_and_capped():
    q = np.array([[3 << 20, -(1 << 30)], [1 << 62, 1 << 62]])
    x = np.array([[1 << 31, 1 << 31], [-(1 << 62), 5]])
    want = [[max(-pivots.MOST, min(pivots.MOST, sum(int(a) * int(b) for a, b in zip(r, c)))) for c in x] for r in q]
    assert pivots.products(q, x).tolist() == want


def test_rings_that_cannot_matter_are_not_opened():
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 900, (6, 32))
    x = np.rint(np.concatenate([c + rng.normal(0, 20, (400, 32)) for c in centre])).astype(np.int64)
    held = pivots.Pivots(x[::40].tolist(), 8)
    way = held.distances(x.astype(float))
    made = whole = 0
    least = np.full(20, -pivots.MOST, np.int64)
    q = x[::120]
    best = np.zeros((len(q), 0), np.int64)
    cells = sorted(set(way.argmin(1)), key=lambda p: -np.mean(q @ x[way.argmin(1) == p].T))
    for p in cells:
        at = np.flatnonzero(way.argmin(1) == p)
        at = at[np.argsort(way[at, p])]
        who, name, score, n = pivots.best_of_block((np.full(len(q), -1), q, least), held.distances(q.astype(float))[:, p], at, way[at, p], x[at], 5)
        made, whole = made + n, whole + len(at) * len(q)
        best = np.stack([np.sort(np.append(best[i], score[who == i]))[::-1][:5].tolist() + [-pivots.MOST] * max(0, 5 - len(best[i]) - (who == i).sum()) for i in range(len(q))])
        least = best[:, 4]
    assert (best == -np.sort(-(q @ x.T), axis=1)[:, :5]).all() and made < whole / 2


@pytest.mark.parametrize("name", ["op11_orchard_clusters", "op12_pivot_top_k"])
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    made = registry.QUERIES[name](spark, folder)
    want = con.sql(registry.ORACLE_SQL[name])
    assert want.columns == made.columns and ordered(map(tuple, made.collect())) == ordered(want.fetchall())
