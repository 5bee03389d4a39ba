"""Operators against brute force, round trips or held-out accuracy, on small fixtures with odd rows."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import annforest, bpe, langid, licences, packing, quality, rules, secrets, warc

DATA = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "one", "é ñ 日本 😀", "a " * 3000, "same line\nsame line\nsame line", "x" * 50_000, "1 2 3 ***"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", f"s{i}") for i, t in enumerate(ODD)] + [(3, "one", None, None), (None, "null key", "en", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS score", "2 AS n_words")


def test_packing_places_every_piece_once(spark, odd):
    encode = packing.tokenizer()
    got = packing.pack_documents(odd, with_ids=True).collect()
    want = []
    for r in odd.collect():
        ids = np.append(encode(r.text or ""), 0).astype("<u4")
        for k, (s, n) in enumerate(packing.cut(len(ids))):
            want.append((r.doc_id is None, r.doc_id or 0, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
    assert sorted((g.doc_id is None, g.doc_id or 0, g.piece, g.start, g.length, g.ids_crc32) for g in got) == sorted(want)
    for sequence in {g.sequence_id for g in got}:
        inside = sorted((g.offset, g.length) for g in got if g.sequence_id == sequence)
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:i]) for i in range(len(inside))]
        assert sum(n for _, n in inside) <= packing.SIZE
    assert packing.pack_documents(odd.where("false")).collect() == []


def drawn(name):
    rng = np.random.default_rng(1)
    return {
        "lognormal": lambda: np.clip(rng.lognormal(6, 1, 20000), 1, 2048).astype(int), "uniform": lambda: rng.integers(1, 2049, 20000),
        "three a sequence": lambda: rng.integers(300, 901, 50000), "thirds and halves": lambda: np.concatenate([rng.integers(600, 720, 9000), rng.integers(980, 1070, 7000)]),
        "two a sequence": lambda: rng.integers(500, 1001, 60000), "few": lambda: np.array([2048, 2048, 1, 5, 1500]), "one": lambda: np.array([7]),
    }[name]()


@pytest.mark.parametrize("name,most", [("lognormal", 1.0005), ("uniform", 1.006), ("three a sequence", 1.008), ("thirds and halves", 1.03), ("two a sequence", 1.051), ("few", 1), ("one", 1)])
def test_plan_is_near_the_lower_bound_and_no_worse_than_best_fit(name, most):
    lengths = drawn(name)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    made = packing.plan(histogram)
    held: dict[int, int] = {}
    for contents, n in made.configurations:
        assert sum(x * k for x, k in contents.items()) <= 2048
        for x, k in contents.items():
            held[x] = held.get(x, 0) + k * n
    assert held == histogram
    assert -(-lengths.sum() // 2048) <= made.bound <= made.sequences <= most * made.bound + 1
    assert made.sequences <= sum(n for _, n in packing.best_fit(histogram))


def test_the_dual_bound_sees_what_sizes_do_not():
    # two of them never fit together, which the sum of sizes cannot tell
    assert packing.plan({1100: 50}).bound == packing.plan({1100: 50}).sequences == 50
    assert packing.plan({}).configurations == []


def test_knapsack_equals_trying_all():
    rng = np.random.default_rng(3)
    value = np.full(31, -np.inf)
    value[[3, 5, 8, 13]] = rng.random(4) * [3, 5, 8, 13]
    best, took = packing.knapsack(value)
    for room in range(31):
        tried = max(sum(n * value[x] for n, x in zip(c, (3, 5, 8, 13), strict=True)) for c in itertools.product(range(11), range(7), range(4), range(3)) if sum(n * x for n, x in zip(c, (3, 5, 8, 13), strict=True)) <= room)
        inside = packing._contents(took, room)
        assert abs(best[room] - tried) < 1e-9 and abs(sum(n * value[x] for x, n in inside.items()) - tried) < 1e-9


def test_packed_ids_equal_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    encode, rng = packing.tokenizer(), random.Random(9)
    letters = "aàbcdeEÉ  .'strmvl0123½ßΣİ日<|>\x1c\x85\xa0​\t\ń\r\U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(700)] + ["<|endoftext|>", "x <|endoftext|>y", "", " " * 300, "it's we'll I'M"]
    for text in texts:
        assert list(encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_bpe_equals_the_library(spark, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    library.no_truncation()
    library.no_padding()
    coder = bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY))
    rng = random.Random(4)
    letters = "aàbcdeEÉ  .'strmvl0123½ßΣİ日<|>\x1c\x85\xa0​\t\ń"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(500)] + ["x<|startoftext|>y <|endoftext|>"]
    for text in texts:
        assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids
    for r in bpe.encode(odd, outputs=True).collect():
        assert list(r.ids) == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == library.decode(list(r.ids), skip_special_tokens=False)


def test_secrets_equal_patterns(spark):
    patterns = [("assign", re.compile(secrets.PATTERNS[0][1]), 1, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]
    rng = random.Random(1)
    parts = ["token", "password", ": ", "=", "'", "abcdefgh12", "AKIA", "0123456789ABCDEF", "deadbeef" * 4, "f", "é", "\U0001f600", " ", "\n", "ApiKey", "/+="]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25))), f"s{i % 7}") for i in range(300)] + [(900, None, None), (None, "token = abcdefgh123", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("spans", F.lit(1))
    for r in secrets.scan(df).collect():
        text = next(t for i, t, _ in rows if i == r.doc_id) or ""
        spans = sorted((m.start(), k, f"{n}:{m.start()}:{m.end()}") for k, (n, p, g, least) in enumerate(patterns) for m in p.finditer(text) if len(m[g]) >= least)
        assert r.base_sha256 == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
        assert {s[2] for s in spans} <= set(r.spans.split(","))
    masked = secrets.mask_secrets(spark, df).select("text").collect()
    assert not any(p.search(r.text or "") and len(p.search(r.text)[g]) >= least for r in masked for _, p, g, least in patterns[1:])


def test_secrets_ownership(spark):
    rows = [(i, "token = copied_everywhere1", f"s{i}") for i in range(9)] + [(20, "token = only_mine_here_1", "s1")]
    got = {r.doc_id: (r.n_live, r.n_copied) for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0] == (0, 1) and got[20] == (1, 0)


def test_warc_round_trip(spark):
    big = "é" * 400_000
    rows = [(5, "u", "<a>"), (3, "u", "<a>"), (4, None, None), (9, "x", ""), (10, "y", big), (1, "z", big), (None, "n", "q"), (7, "k\r\nX: y", "\r\n\r\n"), (3, "u", "<a>")]
    first: dict[bytes, int] = {}
    for p, _, h in rows:
        if p is not None:
            first[(h or "").encode()] = min(first.get((h or "").encode(), p), p)
    want = []
    for p, _, h in rows:
        b = (h or "").encode()
        again = p is not None and first[b] != p
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", first[b] if again else None))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("row", F.lit(1))
    assert sorted(map(repr, map(tuple, warc.round_trip(df).collect()))) == sorted(map(repr, want))
    assert warc.round_trip(df.where("false")).collect() == []


def test_warc_chunk_rows_add_up(spark, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT", 1000)
    rng = random.Random(2)
    # one payload is longer than a segment, and one ends where a chunk does
    rows = [(1, "u", "".join(rng.choice("abcdefghij") for _ in range(3 * warc.CHUNK + 5))), (2, "u", "x" * warc.CHUNK), (3, "u", "x" * warc.CHUNK), (4, "u", None), (5, "u", "\u65e5" * 200_000), (None, None, "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("data", F.lit(1)).withColumn("sha1", F.lit(2))
    folder = warc.archive_folder(spark)
    index = warc.write(df, folder)
    chunks = warc.read_chunks(index, folder).collect()
    assert index.count() > 2 and max(len(c.data) for c in chunks) <= warc.CHUNK
    for page, _, html in rows:
        own = sorted((c for c in chunks if c.page_id == page), key=lambda c: c.chunk_no)
        assert [c.chunk_no for c in own] == list(range(len(own))) and [c.last for c in own] == [False] * (len(own) - 1) + [True]
        stored = b"" if own[0].record_type == "revisit" else (html or "").encode()
        assert b"".join(c.data for c in own) == stored and own[0].payload_bytes == len((html or "").encode())
        upto = hashlib.sha1()
        for c in own:
            upto.update(c.data)
            assert c.running == base64.b32encode(upto.digest()).decode()
    assert {c.page_id for c in chunks if c.record_type == "revisit"} == {3}


def test_neighbours_recall(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(1500, 16))
    v[7] = v[3]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [1.0]), (None, v[0].tolist())]
    got = annforest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        s = unit @ unit[q]
        s[q] = -9
        best = np.lexsort((np.arange(1500), -s))[:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert all(abs(s[i] - x) < 1e-12 for _, i, x in mine)
        hits += len(set(best) & {i for _, i, _ in mine})
    assert {r.query_id for r in got} == set(range(0, 1500, 50))
    assert hits >= 0.9 * 5 * 30


def test_rules_equal_plain_counts(spark, odd):
    for r in rules.judge(odd).collect():
        t = ODD[r.doc_id] if r.doc_id is not None else "null key"
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        seen: dict[tuple, list[int]] = {}
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i : i + 8]), []).append(i)
        repeated = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w))


def test_classifiers_on_held_out_rows(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels).where("held_out").join(labels, "doc_id")
    assert found.where("predicted = quality").count() >= 0.97 * found.count()
    model = langid.train(docs)
    named = langid.identify(docs, model, keep=["doc_id", "lang"]).where(quality.fold(folds=4) == 2)
    assert named.where("lang = lang_pred").count() >= 0.99 * named.count()
    scored = {r.doc_id: r for r in langid.identify(odd.select("doc_id", "text"), model).collect()}
    assert [scored[i].lang_pred for i in (0, 1, 2, 8)] == ["und"] * 4 and scored[3].lang_pred != "und"
    assert quality.classify(odd, labels).count() == odd.count()


def test_licences(spark, odd):
    rows = [(1, "text\nLicensed under the Apache License, Version 2.0.\nmore"), (2, "Released under the MIT License."), (3, "the licence of the driver"), (4, None), (5, "All rights reserved.")]
    got = {r.doc_id: r.families for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "Apache-2.0", 2: "MIT", 3: "", 4: "", 5: "proprietary"}
    assert licences.scan(odd).count() == odd.count()


def test_licences_of_wrapped_notices(spark):
    gpl = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
    mit = """Permission is hereby granted, free of charge,
to any person
obtaining a copy of this software and associated documentation files"""
    other = "The general public came to see this work and had\npermission to enter; a licence\nof the driver was\nrenewed at the office."
    before = "Words that came before it and go on for long.\n" * 40
    made = {"gpl": "GPL-3.0", "bsd": "BSD", "mit": "MIT", "other": ""}
    texts = {"gpl": gpl, "bsd": bsd, "mit": mit, "other": other}
    rows, want = [], {}
    for name, text in texts.items():
        narrow = "\n".join(text.split())
        comment = "\n".join(f" * {x}" for x in text.split("\n"))
        for how, t in {"as is": text, "narrow": narrow, "comment": comment, "crlf": text.replace("\n", "\r\n"), "inside": before + text + "\n" + before, "one line": text.replace("\n", " ")}.items():
            rows.append((f"{name} {how}", t))
            want[f"{name} {how}"] = (1, int(bool(made[name])), made[name])
    rows += [("three", f"{gpl}\n \n{mit}\n\n\n{other}"), ("rights", "All rights\nreserved."), ("both", "Released under the MIT License.\nLicensed under CC BY 4.0.")]
    want |= {"three": (3, 2, "GPL-3.0,MIT"), "rights": (1, 1, "proprietary"), "both": (1, 1, "CC-BY,MIT")}
    got = {r.doc_id: (r.n_paragraphs, r.n_licences, r.families) for r in licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == want


NOTICES = {
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "GPL-2.0",
    "This library is free software; it is under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.": "LGPL-2.1",
    "Text is licensed under CC BY-SA 4.0": "CC-BY-SA", "Licensed under CC BY 4.0": "CC-BY", "Licensed under CC BY-NC 4.0": "CC-BY-NC", "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA",
    "licensed under a Creative Commons Attribution-ShareAlike license": "CC-BY-SA", "// SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0", "SPDX-License-Identifier: LGPL-3.0-or-later": "LGPL-3.0",
    "SPDX-License-Identifier: EPL-2.0": "EPL-2.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "GPL-3.0", "licensed under the Eclipse Public License, version 2.0": "EPL-2.0",
    "Redistributions of source code must retain the above copyright notice, this list of\nconditions and the following disclaimer.": "BSD", "Copyright 2019 by the company. All rights reserved.": "proprietary",
    "License: MIT": "MIT", "This software is licensed under GPLv3.": "GPL-3.0", "License: GPL-3.0": "GPL-3.0", "Apache 2.0 licensed": "Apache-2.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License": "CC-BY-SA",
    "LGPL-2.1 licensed": "LGPL-2.1", "Licensed under the BSD-3-Clause license": "BSD", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)": "BSL-1.0",
    "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software.": "zlib",
    "This is not released under the MIT License.": "", "The old version was under the GPL, this one is no longer licensed under the GPLv3 license": "", "license of GPL-licensed plugins": "", "a license for version 3.0": "",
    "GNU General Public License": "", "it under the terms of the GNU General Public License as published by": "", "a license of the city": "", "SPDX-License-Identifier: NOASSERTION": "",
}


def test_licences_of_near_families(spark):
    rows = list(enumerate(NOTICES))
    got = {r.doc_id: r.families for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {t: got[i] for i, t in rows} == NOTICES


def test_licences_equal_a_plain_scorer_of_all_passages(spark):
    """Without anchors, dictionaries instead of joins: leaving out passages changes nothing."""
    families, weights, bias, threshold = licences.train()

    def plain(passage):
        grams = licences.grams_of(passage)
        p = licences._softmax((bias + sum((weights[g] for g in sorted(grams) if g in weights), np.zeros(len(families))))[None])[0]
        found: dict[str, float] = {}
        for family, text, name in licences.named_templates():
            own = licences.grams_of(text)
            if own & grams & set(licences.anchors()) and licences.grams_of(name) <= grams:
                found[family] = max(found.get(family, 0), len(own & grams) / len(own))
        best = families[int(p.argmax())]
        sure = p.max() >= threshold and found.get(best, 0) >= licences.CONFIRM and all(found[best] > x for f, x in found.items() if f != best)
        return best if sure and best != licences.UNKNOWN else None

    rng = random.Random(5)
    parts = [*NOTICES, "words that mean nothing here", "under version 2", "\n\n", "\n", "\n \n", "* ", "é", "All rights", "reserved", "CC BY", "-SA 4.0", "the MIT", "License"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(120)] + [(200, "w " * 3000 + "Released under the MIT License " + "w " * 3000)]
    got = {r.doc_id: (r.n_paragraphs, r.n_licences, r.families) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("passage", F.lit(1)).withColumn("n", F.lit(1))).collect()}
    for i, text in rows:
        every = [p for p in re.split(r"\n\s*\n", text) if re.search("[A-Za-z0-9]", p)]
        each = []
        for paragraph in every:
            words = re.findall(licences.WORD, paragraph.lower())
            seen = [*paragraph.split("\n"), *(" ".join(words[k : k + licences.WINDOW]) for k in range(0, len(words), licences.STEP))]
            each.append({f for f in map(plain, seen) if f})
        assert got[i] == (len(every), sum(map(bool, each)), ",".join(sorted(set().union(*each)))), text


def test_licences_of_repeated_and_null_rows(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (1, None), (None, "All rights reserved."), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_paragraphs, r.n_licences, r.families) for r in licences.scan(df).collect())
    assert got == [(False, 0, 0, ""), (False, 1, 1, "MIT"), (False, 1, 1, "MIT"), (True, 0, 0, ""), (True, 1, 1, "proprietary")]
    assert licences.scan(df.where("false")).collect() == []
