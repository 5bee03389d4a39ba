"""Verdicts and scores against plain versions that share no code with the operators."""

import math
import re
from collections import Counter, defaultdict

import numpy as np

from cellweave.llm import annforest, neardup, packing, quality, rules, secrets

SF = "/root/testdata/sf0.01"
WORD = r"[^\x20\x09-\x0D]+"


def counted(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = re.findall(WORD, text)
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i : i + 8])].append(i)
    repeated = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), len(w) < 20 or 100 * len(repeated) > 30 * len(w)


def em(patterns, rounds=50):
    """Votes weighed pattern by pattern, rule by rule: no arrays."""
    total = sum(patterns.values())
    start = {True: {"+": 0.85, "-": 0.02, "0": 0.13}, False: {"+": 0.1, "-": 0.6, "0": 0.3}}
    n = len(next(iter(patterns)))
    chance = {c: [dict(start[c]) for _ in range(n)] for c in (True, False)}
    pull, share = max(10.0, 0.01 * total), {True: 0.85, False: 0.15}
    for _ in range(rounds):
        post = {}
        for p in patterns:
            log = {c: math.log(share[c]) + sum(math.log(chance[c][r][v]) for r, v in enumerate(p)) for c in (True, False)}
            post[p] = 1 / (1 + math.exp(log[False] - log[True])) if log[False] - log[True] < 700 else 0.0
        for c in (True, False):
            for r in range(n):
                held = {v: pull * start[c][v] for v in "+-0"}
                for p, k in patterns.items():
                    held[p[r]] += k * (post[p] if c else 1 - post[p])
                chance[c][r] = {v: x / sum(held.values()) for v, x in held.items()}
        good = min(0.99, max(0.01, sum(k * post[p] for p, k in patterns.items()) / total))
        bad = min(0.99, max(0.01, 1 - sum(k * post[p] for p, k in patterns.items()) / total))
        share = {True: good / (good + bad), False: bad / (good + bad)}
    return post


def test_rules_on_the_table(spark):
    """Every document's counts, and the verdict by plain weighing of all votes; documents with one pattern tie."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = rules.query(spark, SF).collect()
    post = em(Counter(r.votes for r in got))
    assert sorted(r.doc_id for r in got) == sorted(text)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counted(text[r.doc_id])
        assert abs(r.posterior - post[r.votes]) < 1e-6 and r.kept == (not r.base_failed and post[r.votes] >= 0.5)
    assert len({r.votes for r in got}) > 5 and 0 < sum(r.kept for r in got) < len(got)


def walked(model, x):
    """One row through all trees, node by node."""
    total = model.start
    for feature, threshold, leaf in zip(model.feature.tolist(), model.threshold.tolist(), model.leaf.tolist(), strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if x[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + math.exp(-total))


def split_gain(x, residual, weight, rows, f, t, ridge=2.0):
    left = [i for i in rows if x[i][f] <= t]
    right = [i for i in rows if x[i][f] > t]
    if sum(weight[i] for i in left) <= 1 or sum(weight[i] for i in right) <= 1:
        return 0.0
    part = lambda own: sum(residual[i] for i in own) ** 2 / (sum(weight[i] for i in own) + ridge)
    return part(left) + part(right) - part(rows)


def test_trees_are_those_of_trying_all_splits():
    """Small tables with ties and constant columns: each split is the best of all, leaves are Newton steps."""
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 6, 60), rng.random(60).round(1), np.ones(60), rng.random(60)], 1)
    y = (x[:, 0] + 3 * x[:, 1] + rng.normal(0, 0.5, 60) > 3.5).astype(float)
    model = quality.fit(x, y, rounds=3, depth=2)
    raw = np.full(60, math.log(y.mean() / (1 - y.mean())))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 49)[1:-1])) for f in range(4)]
    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
        p = 1 / (1 + np.exp(-raw))
        residual, weight = y - p, p * (1 - p)
        where = np.zeros(60, int)
        for node in range(3):
            rows = [i for i in range(60) if where[i] == node]
            best = max(split_gain(x, residual, weight, rows, f, t) for f in range(4) for t in cuts[f])
            mine = split_gain(x, residual, weight, rows, feature[node], threshold[node]) if np.isfinite(threshold[node]) else 0.0
            assert abs(mine - best) < 1e-9
            for i in rows:
                where[i] = 2 * node + (2 if x[i][feature[node]] > threshold[node] else 1)
        for k in range(4):
            own = [i for i in range(60) if where[i] == 3 + k]
            assert abs(leaf[k] - 0.2 * sum(residual[i] for i in own) / (sum(weight[i] for i in own) + 2.0)) < 1e-9
        raw += leaf[where - 3]
    assert np.allclose([walked(model, r) for r in x.tolist()], 1 / (1 + np.exp(-raw)))


def test_classifier_scores_on_the_table(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    text = {r.doc_id: r.text for r in docs.collect()}
    got = quality.query(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(text)
    for r in got:
        want = walked(model, np.asarray(quality.features([text[r.doc_id]]))[0].tolist())
        assert abs(r.score - want) < 1e-9 and r.predicted == int(want >= 0.3) and r.held_out == (quality.crc_fold(r.doc_id, 5) == 0)


def test_odd_columns_and_rows_in_all_stages(spark):
    """Names that operators give, nulls, repeated rows, empty and long texts; then no rows at all."""
    long_text = " ".join(f"word{i % 313} is here" for i in range(20_000))
    texts = [None, "", " \n", "one", long_text, long_text, "token = abcdefgh123 " + " ".join(f"good words {i}" for i in range(40))]
    rows = [(i, t, "en", "s", len(t or ""), 1, 2.0, True, "x") for i, t in enumerate(texts)] + [(None, "null key", None, None, None, None, None, None, None), (4, long_text, "en", "s", 9, 1, 2.0, True, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, score double, kept boolean, spans string")
    for stage in (quality.keep_good, rules.keep_good, neardup.keep_one, secrets.mask_secrets):
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns and made.count() <= len(rows)
        assert stage(spark, docs.where("false"), SF).count() == 0
    packed = packing.packed_stage(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == len({r[0] for r in rows}) and packing.packed_stage(spark, docs.where("false"), SF).count() == 0


def test_forest_on_the_table(spark):
    """Nine in ten of the nearest are found, and of a large table few rows are scored."""
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in annforest.query(spark, folder).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[q]
        s[q] = -9
        best = {int(ids[i]) for i in np.lexsort((ids, -s))[:5]}
        own = sorted(got.pop(int(ids[q])))
        assert [k for k, *_ in own] == [1, 2, 3, 4, 5]
        hits += len(best & {i for _, i, _ in own})
    assert not got and hits >= 0.9 * 5 * (ids % 50 == 0).sum()


def test_a_block_of_a_large_table_is_hardly_read():
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((400, 64))
    v = (np.repeat(centre, 10, axis=0) + 0.7 * rng.standard_normal((4000, 64))).astype(np.float32)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    strings = annforest.hash_strings(unit, annforest.projections(64))
    forest = annforest.Forest(strings)
    asked = np.arange(0, 4000, 40)
    # what a block of a table of ten million gives
    first, last = forest.ranges(strings[asked], math.ceil(annforest.wanted_share(10_000_000) * 4000))
    found = hits = 0
    for k, q in enumerate(asked):
        held = forest.under(first[k], last[k])
        near = np.argsort(-(unit @ unit[q]))[1:6]
        found, hits = found + len(held), hits + len(set(near) & set(held))
    assert found < 0.2 * 4000 * len(asked) and hits >= 0.9 * 5 * len(asked)
