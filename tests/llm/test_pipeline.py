"""The five stages against plain versions of each, and what all operators do with empty tables."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellweave.llm import annforest, bpe, langid, licences, neardup, packing, quality, rules, secrets, warc
from test_neardup import brute

DATA = "/root/testdata/sf0.001"
PATTERNS = [(re.compile(secrets.PATTERNS[0][1]), 1, 8), (re.compile("AKIA[A-Z0-9]+"), 0, 16), (re.compile("[0-9a-f]+"), 0, 32)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("sf")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    some = docs.where("text IS NOT NULL AND lang = 'en'").orderBy("doc_id").limit(3).collect()
    key = "token = abcdefgh_only_here_1"
    odd = [(900, None), (901, ""), (902, " \n "), (-1, some[0].text + f" {key}"), (-1, some[0].text + f" {key}"), (904, some[1].text), (None, some[2].text), (905, (some[2].text + " ") * 40)]
    more = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in odd], docs.schema)
    docs.unionByName(more).withColumn("kept", F.lit(7)).coalesce(2).write.parquet(str(out / "documents.parquet"))
    spark.read.parquet(f"{DATA}/labels.parquet").write.parquet(str(out / "labels.parquet"))
    return str(out)


def rows_of(df):
    return sorted((repr((r.doc_id, r.text)) for r in df.collect()))


def test_each_stage_equals_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "quality_rules", "near_duplicates", "secrets", "packing"]

    model = quality.train(docs, labels)
    kept = [r for r in docs.collect() if model.score(quality.features([r.text]))[0] >= quality.CUT]
    got = stages["quality_classifier"](spark, docs, folder)
    assert got.columns == docs.columns and rows_of(got) == sorted(repr((r.doc_id, r.text)) for r in kept)

    docs = spark.createDataFrame(kept, docs.schema)
    stats = [rules.measure([r.text]) for r in kept]
    votes = [s["votes"][0] for s in stats]
    good = rules.fit_votes({v: votes.count(v) for v in votes})
    kept = [r for r, s, v in zip(kept, stats, votes, strict=True) if not s["base_failed"][0] and good[v] >= rules.CUT]
    got = stages["quality_rules"](spark, docs, folder)
    assert got.columns == docs.columns and rows_of(got) == sorted(repr((r.doc_id, r.text)) for r in kept)

    docs = spark.createDataFrame(kept, docs.schema)
    component = {i: c for i, (_, c) in brute([(r.doc_id, r.text) for r in kept if r.doc_id is not None]).items()}
    once, seen = [], set()
    for r in kept:
        if r.doc_id is None or (component[r.doc_id] == r.doc_id and (r.doc_id, r.text) not in seen):
            seen.add((r.doc_id, r.text))
            once.append(r)
    got = stages["near_duplicates"](spark, docs, folder)
    assert got.columns == docs.columns and rows_of(got) == sorted(repr((r.doc_id, r.text)) for r in once)

    docs = spark.createDataFrame(once, docs.schema)
    held = {}
    for r in once:
        for p, group, least in PATTERNS:
            for m in p.finditer(r.text):
                if len(m[group]) >= least:
                    held.setdefault(m[group], set()).add((r.doc_id, r.source))
    live = {v for v, at in held.items() if len({s for _, s in at if s is not None}) < secrets.OWNERS and len({i for i, _ in at if i is not None}) < secrets.REPOSITORIES}
    want = []
    for r in once:
        places: list[list] = []
        for b, e, v in sorted((m.start(), m.end(), m[g]) for p, g, least in PATTERNS for m in p.finditer(r.text) if len(m[g]) >= least):
            if places and b < places[-1][1]:
                places[-1] = [places[-1][0], max(e, places[-1][1]), places[-1][2] or v in live]
            else:
                places.append([b, e, v in live])
        text, at = "", 0
        for b, e, is_live in places:
            text, at = text + r.text[at:b] + (secrets.MASK if is_live else secrets.COPIED_MASK), e
        want.append((r.doc_id, text + r.text[at:]))
    got = stages["secrets"](spark, docs, folder)
    assert got.columns == docs.columns and rows_of(got) == sorted(map(repr, want)) and "[SECRET]" in repr(want)
    assert all(r.n_chars == len(r.text) for r in got.collect())

    encode, pieces = packing.tokenizer(), []
    for i, text in want:
        ids = np.append(encode(text), 0).astype("<u4")
        pieces += [(i is None, i or 0, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids)))]
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted((g.doc_id is None, g.doc_id or 0, g.piece, g.start, g.length, g.ids_crc32) for g in found) == sorted(pieces)
    for sequence in {g.sequence_id for g in found}:
        inside = sorted((g.offset, g.length) for g in found if g.sequence_id == sequence)
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:k]) for k in range(len(inside))] and sum(n for _, n in inside) <= packing.SIZE


def test_empty_tables_give_no_rows(spark, folder, tmp_path):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    none = docs.where("false")
    model = langid.train(docs)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<double>")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for made in (
        licences.scan(none), packing.pack_documents(none), neardup.near_duplicates(none), secrets.scan(none), bpe.encode(none), langid.identify(none, model), warc.round_trip(pages),
        annforest.search(vectors), rules.judge(none), quality.classify(none, labels), neardup.keep_one(spark, none), secrets.mask_secrets(spark, none), rules.keep_good(spark, none), quality.keep_good(spark, none, folder),
    ):
        assert made.collect() == []


def test_language_model_equals_a_plain_scorer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs)
    for r in langid.identify(docs.select("doc_id", "text"), model).limit(40).collect():
        if not langid.has_letter(r.text):
            assert r.lang_pred == "und"
            continue
        ids, _ = langid.subwords([r.text])
        z = (sum((model.table[i] for i in ids.ravel()), np.zeros(model.table.shape[1])) / ids.size + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.lang_pred == model.languages[int(p.argmax())] and abs(r.score - p.max()) < 1e-3


def test_ties_repeats_and_clashing_columns_of_neighbours(spark):
    rows = [(0, [1.0, 0.0], 9), (0, [1.0, 0.0], 9), (1, [2.0, 0.0], 9), (2, [1.0, 1.0], 9), (3, [1.0, -1.0], 9), (50, [0.0, 1.0], 9), (7, [0.0, -1.0], 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").withColumn("rank", F.lit(1)).withColumn("entry", F.lit(1))
    got = sorted((r.query_id, r.rank, r.vec_id) for r in annforest.search(df).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 7), (0, 5, 50), (50, 1, 2), (50, 2, 0), (50, 3, 1), (50, 4, 3), (50, 5, 7)]
