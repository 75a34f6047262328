"""Operators on all documents together: near-duplicates, packing, neighbours, pipeline."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from llm import samples
from reqmill.llm import components, nearest, packing, queries, simhash

SF = "/root/testdata/sf0.001"


# 5. SimHash.


def print_by_hand(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_by_hand(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_links_against_brute_force(spark):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(150)} | {0, 2 ** 64 - 1}
    for v in list(values)[:60]:  # chains, stars and a crowd within few bits of each other
        for _ in range(4):
            v ^= 1 << rng.randrange(64)
            values.add(v)
    base = rng.getrandbits(64)
    values |= {base ^ (1 << i) ^ (1 << j) for i in range(9) for j in range(9)}
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    nodes = sorted(signed)
    pairs = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1:] if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2]
    frame = spark.createDataFrame([(v,) for v in nodes], "fp long")
    links = simhash.links(frame)
    assert all(((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= 2 for r in links.collect())
    got = {r.node: r.root for r in components.components(links).collect()}
    assert {n: got.get(n, n) for n in nodes} == roots_by_hand(pairs, nodes)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (301, 300), (300, 301)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: r for n, r in roots_by_hand(edges, {x for e in edges for x in e}).items()}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    prints = {d: print_by_hand(t) for d, t in docs}
    ids = sorted(prints)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (prints[a] ^ prints[b]).bit_count() <= 2]
    rows = {r.doc_id: r for r in queries.op5_simhash(spark, SF).collect()}
    assert {d: (rows[d].fingerprint, rows[d].component_id) for d in ids} == {
        d: (f"{prints[d]:016x}", root) for d, root in roots_by_hand(pairs, ids).items()}


def test_simhash_odd_rows(spark):
    rows = simhash.groups(samples.odd(spark)).collect()
    assert len(rows) == len(samples.ODD)
    by = {r.doc_id: r for r in rows if r.doc_id}
    assert [by[i].component_id for i in (1, 2, 3)] == [1, 1, 1] and by[1].fp == 0
    assert by[8].component_id == 7 and by[9].component_id == 7  # case and white space don't count
    assert simhash.groups(samples.empty(spark)).count() == 0


def test_one_row_stays_of_each_group(spark):
    docs = samples.odd(spark)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    groups = {r.root for r in simhash.groups(docs).collect()}
    assert kept.count() == len(groups)
    twice = spark.createDataFrame([(1, "x y z")] * 3 + [(2, "x y z"), (1, "other text"), (None, "q"), (None, "q")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in simhash.representatives(twice).collect()) == [(0, "q"), (1, "other text"), (1, "x y z")]


# 7. Packing.


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("lengths", [[], [9], [1] * 50, [4] * 9, [5, 5, 4, 4, 3, 3, 2, 1], [7, 6, 3, 3, 3, 1, 9, 9], list(range(1, 10)) * 7])
def test_plan_places_every_piece_once(lengths):
    counts = {n: lengths.count(n) for n in lengths}
    rows = []
    for length, first, n, per, sequence, offset in packing.plan(counts, 9):
        rows += [{"rank": (length, first + i), "sequence_id": sequence + i // per, "offset": offset + i % per * length, "length": length} for i in range(n)]
    assert sorted(r["rank"] for r in rows) == sorted((n, i) for n, c in counts.items() for i in range(c))
    assert check_places(rows, 9) <= 1.5 * sum(lengths) / 9 + 1


def test_large_pieces_pair_as_well_as_can_be():
    rng = random.Random(6)
    for _ in range(50):
        lengths = sorted(rng.choices(range(34, 101), k=rng.randint(1, 9)))

        def fewest(left):
            if not left:
                return 0
            rest = left[:-1]
            return 1 + min([fewest(rest)] + [fewest(rest[:i] + rest[i + 1:]) for i, x in enumerate(rest) if x + left[-1] <= 100])

        runs = packing.plan({n: lengths.count(n) for n in lengths}, 100)
        assert max(q + n // p for _, _, n, p, q, _ in runs) == fewest(lengths)


def test_packing_query(spark):
    rows = queries.op7_packing(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    used = check_places([r.asDict() for r in rows], 2048)
    assert used <= sum(r.length for r in rows) / 2048 + 2
    tokenizer, by = Tokenizer.from_file(queries.WORD_BPE), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by.keys() == docs.keys()
    for d, text in docs.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        parts = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by[d])
        assert parts == [(i, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for i, s in enumerate(range(0, len(ids), 2048))]


def test_words_equal_the_tokenizer():
    whole = Tokenizer.from_file(queries.WORD_BPE)
    words, rng = packing.WordIds(queries.WORD_BPE), random.Random(8)
    pieces = ["ab", "Hello", " ", "1", "É", "\n", "'s", "-", "\x1c", "\x85", "²", "ß", "Σ", "́", "\xa0", "'LL", "µ", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "\x00", "İ", "字"]
    for _ in range(2000):
        text = "".join(rng.choice(pieces) for _ in range(9))
        ids = b"".join(map(words.__getitem__, text.encode().split()))
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, ascii(text)


def test_packing_odd_rows(spark):
    packed = packing.pack(samples.odd(spark), queries.WORD_BPE, capacity=64)
    rows = packed.collect()
    check_places([r.asDict() for r in rows], 64)
    assert sum(r.piece == 0 for r in rows) == len(samples.ODD) and {r.length for r in rows if r.doc_id in (1, 2, 3)} == {1}
    ids = {r.sequence_id: list(r.ids) for r in packing.sequences(packed).collect()}
    assert all(ids[r.sequence_id][r.offset:r.offset + r.length] == list(r.ids) for r in rows)
    assert packing.pack(samples.empty(spark), queries.WORD_BPE).count() == 0


# 10. Neighbours.


def nearest_by_hand(rows, queries_, k):
    out = {}
    for q in queries_:
        d = sorted((float(np.sqrt(((np.array(v) - np.array(rows[q])) ** 2).sum())), i) for i, v in rows.items() if i != q)
        out[q] = d[:k]
    return out


def test_neighbours_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (100, [1.0, 0.1]), (100, [1.0, 0.1]), (200, [1.0, 0.0]),
            (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("list", F.lit(1))
    got = defaultdict(list)
    for r in nearest.neighbours(frame, F.col("vec_id") % 100 == 0, k=3).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    used = {i: np.array(v, np.float32).astype(float) for i, v in rows if i in (0, 1, 2, 100, 200)}
    assert got == nearest_by_hand(used, [0, 100, 200], 3)
    assert nearest.neighbours(frame.where("vec_id = 4"), F.lit(True)).count() == 0
    assert nearest.neighbours(frame.where("vec_id = 0"), F.lit(True)).count() == 0


def test_copies_keep_their_smallest_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(60)] + [(60 + i, rng.normal(size=3).tolist()) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in nearest.neighbours(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    assert got == nearest_by_hand(dict(rows), [0, 50, 100, 150, 200, 250], 10)


def test_scan_abandons_without_losing_many():
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(3000, 64)), rng.normal(size=(20, 64))
    rotation = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    hits = 0
    for i, found, distance in nearest.scan(q, x, rotation, 10):
        true = np.sqrt(((x - q[i]) ** 2).sum(axis=1))
        assert np.allclose(true[found], distance, rtol=0, atol=1e-12)
        hits += len(set(found) & set(true.argsort()[:10]))
    assert hits >= 195


def test_recall_against_brute_force(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {r.vec_id: list(r.embedding) for r in frame.collect()}
    want = nearest_by_hand(rows, [i for i in rows if i % 100 == 0], 10)
    got = defaultdict(list)
    for r in queries.op10_nearest(spark, "/root/testdata/sf0.01").collect():
        got[r.query_id].append(r.vec_id)
    assert got.keys() == want.keys()
    assert np.mean([len({i for _, i in want[q]} & set(got[q])) / 10 for q in want]) >= 0.9


# The pipeline.


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == columns, name
        assert docs.exceptAll(before).count() == 0
        sizes.append((before.count(), docs.count()))
    assert all(a >= b > 0 for a, b in sizes)
    prints = [print_by_hand(r.text) for r in docs.select("text").collect()]
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[i + 1:])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    check_places([r.asDict() for r in packed], 2048)


def test_pipeline_on_odd_rows(spark):
    docs = samples.odd(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.count()
    empty = samples.odd(spark).where("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_quality_without_labels_keeps_all(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").where("1 = 0").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.good_quality(spark, docs, str(tmp_path)).count() == docs.count()
