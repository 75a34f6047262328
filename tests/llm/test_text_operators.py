"""Operators on single documents: toxicity, language, rules, BPE, quality, sharding."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import compare
from llm import samples
from reqmill.llm import byte_bpe, language, licenses, quality_model, quality_rules, queries, sharding, toxicity

SF = "/root/testdata/sf0.001"


def everyone(column):
    return F.lit(True)


# Queries against their SQL.


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_matches_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF), compare.connect(SF), queries.ORACLES[name]) == []


# 1. Toxicity.


@pytest.fixture(scope="module")
def tox(spark):
    good = samples.prose(240)
    bad = [t.replace(" ", f" grob{'abcdefgh'[i % 8]}x ", 1) for i, t in enumerate(samples.prose(80, seed=1))]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i >= len(good))) for i, _ in rows], "doc_id long, quality int, toxic int")
    return toxicity.train(docs, labels, F.col("doc_id") % 5 != 0), docs, labels


def test_toxicity_learns_from_bags_and_locates(spark, tox):
    model, docs, labels = tox
    held = docs.where("doc_id % 5 = 0").join(labels, "doc_id")
    rows = toxicity.score(held, model, keep=("doc_id", "toxic")).collect()
    assert all((r.score >= 0.5) == bool(r.toxic) for r in rows) and all(0 <= r.score <= 1 for r in rows)
    text = "the river walks. every stone grobcx under light!\nthe house"
    found = toxicity.locate(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [(r.sentence, text[r.begin:r.end]) for r in found] == [(" every stone grobcx under light",) * 2]


def test_toxicity_odd_rows(spark, tox):
    model, docs, labels = tox
    rows = toxicity.score(samples.odd(spark), model).collect()
    assert len(rows) == len(samples.ODD) and all(0 <= r.score < 0.5 for r in rows)
    assert toxicity.score(samples.empty(spark), model).count() == 0
    nothing = toxicity.train(samples.empty(spark), labels, everyone(0))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} and toxicity.locate(samples.odd(spark), nothing).count() == 0
    repeated = labels.unionByName(labels.withColumn("toxic", F.lit(None).cast("int")))
    assert toxicity.train(docs, repeated, F.col("doc_id") % 5 != 0).bias == pytest.approx(model.bias)


def test_scores_are_the_noisy_or_of_the_table(spark, tox):
    """Every factor written out: features from the model's table, sentences, documents."""
    model, docs, _ = tox
    texts = {r.doc_id: r.text for r in docs.where("doc_id % 7 = 0").collect()} | {1000 + i: t or "" for i, (_, t) in enumerate(samples.ODD) if t != samples.LONG}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in toxicity.score(frame, model).collect():
        clean = 1.0
        for part in [p for p in re.split("[.!?\n]", texts[r.doc_id]) if p.strip()] or [""]:
            z = model.bias
            for word in set(part.lower().split()):
                raw = word.strip(toxicity.EDGES).encode()
                places = [zlib.crc32(raw + b"=") % toxicity.TABLE] if raw else []
                places += [zlib.crc32(raw[:n]) % toxicity.TABLE for n in range(4, min(len(raw), 8) + 1)]
                z += sum(float(model.weights[p]) for p in places)
            clean *= 1 - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        assert r.score == pytest.approx(1 - clean, abs=1e-9)


def test_only_labels_of_documents_that_are_here_teach(spark, tox):
    """However many labels other documents have, and whatever texts repeat an id."""
    model, docs, labels = tox
    learn = F.col("doc_id") % 5 != 0
    absent = spark.range(10_000, 40_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    again = toxicity.train(docs, labels.unionByName(absent), learn)
    assert again.bias == pytest.approx(model.bias) and np.array_equal(again.known, model.known)
    twice = docs.unionByName(docs.where("doc_id = 1").withColumn("text", F.lit("another text")))
    one, two = toxicity.train(twice, labels, learn), toxicity.train(twice.orderBy(F.desc("text")), labels, learn)
    assert one.bias == two.bias and np.array_equal(one.weights, two.weights)


def test_noisy_or():
    assert toxicity.noisy_or(iter([0.5, 0.5])) == pytest.approx(0.75) and toxicity.noisy_or(iter([])) == 0
    assert toxicity.sentences("") == [(0, 0)] and toxicity.sentences("a. b") == [(0, 1), (2, 4)]


# 2. Licenses.

APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License.  You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_licence_sentences_and_rules(spark):
    texts = [APACHE, "Some prose. Released under the MIT License.\nMore prose", "ALL RIGHTS\nRESERVED.", "All rights reserved. Licensed under CC BY-NC 4.0.",
             "This license is mine", None, "", "licensed under\nthe Apache License, Version 2.0.", "All rights reserved and more"]
    rows = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[i].licences for i in range(9)] == [
        ["Apache-2.0"], ["MIT"], ["Proprietary"], ["CC-BY-NC-4.0", "Proprietary"], [], [], [], ["Apache-2.0"], []]
    assert rows[1].sequence == "<?><MITNotice><?>" and rows[3].identifiers == ["AllRights", "CCBYNC4Notice"]


MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
BSD2 = """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
ENDORSE = """3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"'
GPL2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU {}General Public License
as published by the Free Software Foundation{} either version {}
of the License, or (at your option) any later version."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""


def test_whole_licence_files(spark):
    cases = [(MIT, "MIT"), (MIT.split("\n\n", 1)[1], "MIT"), (MIT.replace("\n", "\r\n"), "MIT"), (BSD2 + AS_IS, "BSD-2-Clause"),
             (BSD2.replace("All rights reserved.\n", "") + AS_IS, "BSD-2-Clause"),
             (BSD2 + ENDORSE.format("the copyright holder") + AS_IS, "BSD-3-Clause"), (BSD2 + ENDORSE.format("Some Company, Inc.") + AS_IS, "BSD-3-Clause"),
             (GPL2.format("", ";", "2"), "GPL-2.0-or-later"), (GPL2.format("", ",", "3"), "GPL-3.0-or-later"),
             (GPL2.format("Lesser ", ";", "2.1"), "LGPL-2.1-or-later"), (GPL2.format("Lesser ", ",", "3"), "LGPL-3.0-or-later"),
             ("Copyright (c) Some Body\n\n" + ISC, "ISC"), ("// SPDX-License-Identifier: BSD-3-Clause\nint x;", "BSD-3-Clause"),
             ("# SPDX-License-Identifier: Apache-2.0\n", "Apache-2.0")]
    rows = licenses.scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.licences for r in rows} == {i: [x] for i, (_, x) in enumerate(cases)}


def test_licence_tables():
    texts = [t for ts in licenses.SENTENCES.values() for t in ts]
    assert len(set(texts)) == len(texts) and all(any(h in t for h in licenses.HINTS) for t in texts)
    assert all(set(ids) <= set(licenses.SENTENCES) for _, ids in licenses.RULES)
    # No rule can hide one that is tried after it.
    patterns = [licenses.pattern(ids) for _, ids in licenses.RULES]
    assert not any(a in b for i, a in enumerate(patterns) for b in patterns[i + 1:])


def test_licences_of_odd_rows(spark):
    rows = licenses.scan(samples.odd(spark)).collect()
    assert len(rows) == len(samples.ODD) and all(r.licences == [] and r.identifiers == [] for r in rows)
    assert licenses.scan(samples.empty(spark)).count() == 0


# 3. Language.


@pytest.fixture(scope="module")
def net(spark):
    parts = {"en": ("the", "of", "shall", "with", "they"), "de": ("der", "und", "schön", "über", "nicht"),
             "fr": ("les", "été", "que", "dans", "où")}
    rows = [(100 * k + i, t, lang) for k, (lang, w) in enumerate(parts.items()) for i, t in enumerate(samples.prose(60, k, w))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return language.train(docs, F.col("doc_id") % 5 != 0), docs


def test_language_held_out(net):
    fitted, docs = net
    rows = language.predict(docs.where("doc_id % 5 = 0"), fitted, keep=("doc_id", "lang")).collect()
    assert len(rows) == 36 and all(r.lang_pred == r.lang for r in rows)


def test_language_odd_rows(spark, net):
    fitted, _ = net
    rows = language.predict(samples.odd(spark), fitted).collect()
    assert len(rows) == len(samples.ODD)
    by = {r.doc_id: r for r in rows if r.doc_id}
    assert all((by[i].lang_pred, by[i].score) == (language.UND, 0.0) for i in (1, 2, 3))
    assert all(r.lang_pred in [*fitted.langs, language.UND] and 0 <= r.score <= 1 for r in rows)
    digits = spark.createDataFrame([(1, "12 ² !")], "doc_id long, text string")
    assert language.predict(digits, fitted).first().lang_pred == language.UND
    none = language.train(samples.empty(spark), everyone(0))
    assert {r.lang_pred for r in language.predict(samples.odd(spark), none).collect()} == {language.UND}


def test_convolution_by_plain_loops(net):
    net = net[0]
    rows = language.windows("the river walks über die Straße, l'été".encode() * 9)
    got = language.logits(net, rows)
    wide = max(language.WIDTHS)
    for row, out in zip(rows, got):
        vectors = [net.embed[b] for b in row] + [np.zeros(language.EMBED)] * (wide - 1)
        top = np.full(net.conv.shape[1], -np.inf)
        for at in range(language.LENGTH):
            for k, width in enumerate(language.WIDTHS):
                for f in range(k * language.FILTERS, (k + 1) * language.FILTERS):
                    weights = net.conv[:, f].reshape(wide, language.EMBED)
                    top[f] = max(top[f], sum(float(vectors[at + j] @ weights[j]) for j in range(width)))
        hidden = np.maximum(top + net.bias, 0)
        assert np.allclose(hidden @ net.out + net.out_bias, out, atol=1e-3)


def test_repeated_rows_teach_once(spark):
    texts = [(i, ["en", "de"][i % 2], t) for i, t in enumerate(samples.prose(30))]
    once = spark.createDataFrame(texts, "doc_id long, lang string, text string")
    many = once.unionByName(once.where("doc_id < 3").withColumn("_x", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("_x"))
    one, two = language.train(once, everyone(0)), language.train(many, everyone(0))
    assert np.array_equal(one.conv, two.conv) and np.array_equal(one.out, two.out)


def test_every_byte_counts():
    raw = bytes(range(256)) * 3 + b"tail"
    rows = language.windows(raw)
    assert bytes(rows[rows < 256].astype(np.uint8)) == raw and language.windows(b"").shape == (1, language.LENGTH)


# 4. Quality rules.


def by_hand(text):
    words = [w for w in __import__("re").split("[ \t-\r]+", text or "") if w]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated))


def test_rules_against_brute_force(spark):
    rng = random.Random(4)
    texts = [t for _, t in samples.ODD] + ["".join(rng.choice(["a ", "b ", "c\n", "#", "  ", "é", "\x0b"]) for _ in range(rng.randint(0, 90)))
                                          for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.measure(docs).collect()}
    assert got == {i: by_hand(t) for i, t in enumerate(texts)}


def test_policies_and_ablations(spark):
    recorded = quality_rules.ledger(samples.odd(spark))
    assert recorded.count() == len(samples.ODD) and quality_rules.ledger(samples.empty(spark)).count() == 0
    rows = {(r.policy, r.version, r.rule): r for r in quality_rules.ablations(recorded).collect()}
    failures = [r.failures for r in recorded.collect()]
    for p in quality_rules.POLICIES:
        for rule in p.rules:
            bit = 1 << list(quality_rules.RULES).index(rule)
            r = rows[p.name, p.version, rule]
            assert r.n_failed == sum(bool(f & bit) for f in failures)
            assert r.n_kept_without == sum(not f & p.mask & ~bit for f in failures)
    assert quality_rules.latest("prose").version == 3
    masks = {(p.name, p.version): p.mask for p in quality_rules.POLICIES}
    assert masks == {("base", 1): 0b11, ("prose", 1): 0b1111, ("prose", 2): 0b111111, ("prose", 3): 0b1110111}  # stored ledgers go by these


# 6. Sharding.


def test_table_is_even_and_moves_little(spark):
    before, after = sharding.fill(sharding.names(32)), sharding.fill(sharding.names(33))
    assert set(np.ptp(list(Counter(t).values())) <= 1 for t in (before, after)) == {True}
    moved = sum(a != b for a, b in zip(before, after))
    assert moved < 3 * sharding.SLOTS / 33
    for shards, slots in ((["a", "a"], 7), ([], 7), (["a"], 8), (["a", "b", "c", "d"], 3)):
        with pytest.raises(ValueError):
            sharding.fill(shards, slots)


def test_sharding_odd_rows(spark):
    rows = sharding.place(samples.odd(spark), "doc_id", sharding.names()).collect()
    assert len(rows) == len(samples.ODD) and len({(r.slot, r.shard) for r in rows if r.doc_id in (8, None)}) == 2
    assert sharding.place(samples.empty(spark), "doc_id", sharding.names()).count() == 0


# 8. Byte-level BPE.

RANKS = queries.BYTE_RANKS


@pytest.fixture(scope="module")
def reference_encoding():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(RANKS), special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(32_768, 512), (64, 12), (16, 1)])
def test_bpe_equals_the_library_and_round_trips(spark, reference_encoding, chunk, overlap):
    rng = random.Random(chunk)
    pieces = ["a", "bc", " ", "  ", "\n", "'s", "12", "é", "œ", "-", "!!", "\t", "字", "\U00013000", "\x1c", "\x85"]
    texts = [t for _, t in samples.ODD if t != samples.LONG] + ["x" * 300, " " * 90 + "y", samples.LONG[:3000]]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 300))) for _ in range(40)]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("_doc", F.lit("x"))
    rows = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk, overlap), RANKS).collect()
    want = sorted((i // 2, reference_encoding.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(texts))
    assert sorted((r.doc_id, list(r.ids), bytes(r.bytes)) for r in rows) == want


def test_bpe_query(spark, reference_encoding):
    rows = {r.doc_id: r for r in queries.op8_byte_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = reference_encoding.encode_ordinary(d.text or "")
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    assert byte_bpe.encode(samples.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


# 9. Quality classifier.


@pytest.fixture(scope="module")
def quality(spark):
    good, bad = samples.prose(150), [f"{w} " * 40 for w in samples.prose(50, 2)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(200)], "doc_id long, quality int")
    return quality_model.train(docs, labels, F.col("doc_id") % 4 != 2), docs, labels


def test_quality_held_out(quality):
    model, docs, labels = quality
    held = docs.where("doc_id % 4 = 2").join(labels, "doc_id")
    rows = quality_model.score(quality_model.measured(held, keep=("doc_id", "quality")), model).collect()
    assert len(rows) == 50 and all((r.score >= 0.7) == bool(r.quality) and 0 <= r.score <= 1 for r in rows)


def test_quality_odd_rows(spark, quality):
    model, docs, labels = quality
    rows = quality_model.score(quality_model.measured(samples.odd(spark)), model).collect()
    assert len(rows) == len(samples.ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality_model.score(quality_model.measured(samples.empty(spark)), model).count() == 0
    ones = quality_model.train(docs, labels.where("quality = 1"), everyone(0))
    none = quality_model.train(docs, samples.empty(spark, "doc_id long, quality int"), everyone(0))
    assert (ones, none) == (1.0, 0.5)


def test_fit_equals_one_solve_over_all_rows(spark):
    """However the rows are dealt out."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, len(quality_model.STATS)))
    y = (x[:, 0] + x[:, 1] ** 2 + 0.3 * rng.normal(size=400) > 0.7).astype(float)
    frame = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "stats array<double>, label double")
    models = [quality_model.fit(frame.repartition(n)) for n in (1, 7, 40)]
    for m in models:
        z = np.clip((x - x.mean(0)) / x.std(0), -quality_model.CLIP, quality_model.CLIP)
        waves = np.hstack([np.sqrt(2 / quality_model.FEATURES) * np.cos(z @ m.turns + m.phases), np.ones((400, 1))])
        penalty = quality_model.RIDGE * 400 / quality_model.FEATURES * np.diag([1.0] * quality_model.FEATURES + [0.0])
        weights = np.linalg.solve(waves.T @ waves + penalty, waves.T @ y)
        assert np.allclose(waves @ weights, m.cosines(x) @ m.weights, atol=1e-6)
        assert (np.diff(m.levels) >= 0).all()
        scores = m.levels[m.bins(x)]
        for level in np.unique(scores):  # a calibrated score is the share of ones that have it
            assert y[scores == level].mean() == pytest.approx(level, abs=0.02) or (scores == level).sum() < 20
    assert np.mean((models[0].levels[models[0].bins(x)] > 0.5) == y) > 0.9


def test_isotonic_pools_what_falls():
    n, ones = np.array([2.0, 0, 2, 2, 0]), np.array([1.0, 0, 0, 2, 0])
    assert quality_model.isotonic(n, ones).tolist() == [0.25, 0.25, 0.25, 1.0, 1.0]


# Held-out accuracy on the given tables.


@pytest.mark.parametrize("name,label,least", [("op1_toxicity", "toxic", 0.75), ("op9_quality_model", "quality", 0.9), ("op3_language", "lang", 0.95)])
def test_queries_on_tables(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES[name](spark, sf)
    truth = spark.read.parquet(f"{sf}/{'documents' if label == 'lang' else 'labels'}.parquet").select("doc_id", label)
    rows = out.join(truth, "doc_id").where("held_out").collect()
    assert out.count() == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % (4 if name[2] == "9" else 5) == (2 if name[2] == "9" else 0)) for r in rows)
    right = [(r.lang_pred if label == "lang" else r.predicted) == r[label] for r in rows]
    assert np.mean(right) >= least
