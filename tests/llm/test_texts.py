"""Operators on documents against brute force, on odd rows: nulls, empty and long texts, repeats, clashing columns."""

import collections
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillpanel.llm import decontaminate, licences, mixing, near_dups, quality, sharding, token_counts
from tillpanel.llm.common import Words, kth_largest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, row long, bucket int, shard int, block int"
LONG = "word " * 400_000


def odd(spark):
    rows = [(1, None), (2, ""), (3, "!!!"), (None, "a b c"), (None, "a b c"), (4, "A b, c"), (5, LONG), (5, LONG),
            (6, "one　two <|endoftext|>\x1c 3² it's"), (7, "x" * 3_000_000), (8, None)]
    return spark.createDataFrame([(i, t, None, None if i is None else "s", None, 0, 0, 0, 0, 0) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("hot", [10, 200_000])
def test_token_counts_equal_the_library(spark, docs, hot):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer())
    rows = docs.select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text").filter("doc_id <> 7 or doc_id is null"))
    got = token_counts.token_counts(rows, tokenizer(), hot=hot).collect()
    want = [(r[0], len((r[1] or "").encode()), len(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows.collect()]
    assert collections.Counter((r[0], r[1], r[2]) for r in got) == collections.Counter(want)
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    assert token_counts.token_counts(rows.limit(0), tokenizer()).count() == 0


def test_pretoken_rule_equals_the_library():
    from tokenizers import pre_tokenizers

    lib, g = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True), np.random.default_rng(1)
    for _ in range(5000):
        t = "".join(chr(c) for c in np.where(g.random(12) < 0.5, g.integers(0, 0x250, 12), g.choice([32, 97, 39, 115, 10, 48], 12)))
        assert [t[a:b] for _, (a, b) in lib.pre_tokenize_str(t)] == token_counts.NARROW.findall(t)


def test_word_hashes_do_not_depend_on_neighbours():
    alone, both = Words([b"the Cat sat"]), Words([b"zz", b"THE cat, sat!", b"", b"x"])
    assert (alone.hashes == both.hashes[1:4]).all() and both.bounds.tolist() == [0, 1, 4, 4, 5]
    assert len(Words([LONG.encode()]).hashes) == 400_000
    h, owner = Words([b"a b", b"a b c d e f", b""]).shingles(5)
    assert owner.tolist() == [0, 1, 1] and len(set(h.tolist())) == 3


def test_quality_keeps_good_and_refuses_junk(spark):
    good = [(i, " ".join(f"w{(i * 7 + j * j) % 50}" for j in range(60))) for i in range(300)]
    junk = [(1000 + i, " ".join(f"w{(i + j) % 50}%%%" for j in range(60))) for i in range(100)]
    rows = spark.createDataFrame(good + junk, "doc_id long, text string").withColumn("__note", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in good + junk] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["keep"] for r in quality.resample(rows, labels).collect()}
    assert np.mean([got[i] for i, _ in good]) > 0.97 and not any(got[i] for i, _ in junk)
    kept = quality.keep_good(rows, labels)
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} == {i for i, k in got.items() if k}
    assert quality.resample(rows, labels, k=17).filter("keep").count() == 17
    assert quality.keep_good(odd(spark), labels.limit(0)).count() == odd(spark).count()
    assert quality.resample(rows.limit(0), labels).count() == 0


def test_quality_counts_in_bounded_memory():
    texts = [" ".join(f"w{(7 * i + k) % 997} ," for k in range(2_000)) for i in range(320)]  # 4 MB, a slice of the former size
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    try:
        out, = quality._count(SimpleNamespace(value=frozenset(range(0, 320, 2))))(iter([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    words = [w for t in texts for w in t.split()]
    grams = 2 * len(words) - len(texts) + sum(len(w) >= 4 for w in words)  # words, pairs and beginnings of 4 bytes
    assert sum(out.column("raw").to_pylist()) == 2 * grams
    assert peak < 200e6, f"{peak / 1e6:.0f} MB"



def test_kth_largest(spark):
    values = [1.0, 2.0, 2.0, -5.5, 1e-9, 7.25]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [kth_largest(df, "v", k) for k in range(1, 6)] == sorted(values, reverse=True)[:5]
    assert kth_largest(df, "v", 0) == float("inf") and kth_largest(df, "v", 6) == float("-inf")


def near_copies():
    g = np.random.default_rng(0)
    rows = []
    for group in range(6):
        words = [f"g{group}w{x}" for x in g.integers(0, 10_000, 200)]
        for copy in range(5):
            w = list(words)
            for j in g.integers(0, 200, 2):
                w[j] = f"changed{copy}{j}"
            rows.append((group * 10 + copy, " ".join(w)))
    return rows + [(100 + i, " ".join(f"u{i}x{x}" for x in g.integers(0, 10_000, 100))) for i in range(20)] + [(200, rows[0][1]), (201, rows[0][1])]


def test_near_duplicates_equal_brute_force(spark):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["keep"]) for r in near_dups.near_duplicates(df).collect()}
    idf = near_dups.idf_table(df)
    sets = []
    for _, t in rows:
        _, h, n = near_dups.weighted_set([t.encode()])
        sets.append((h, n))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if near_dups.similarity(sets[i], sets[j], idf) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    want = {d: min(g) for g in least.values() for d in g}
    assert {d: c for d, (c, _) in got.items()} == want
    assert all(k == (c == d) for d, (c, k) in got.items())
    kept = near_dups.keep_first(df.withColumn("__x", F.lit(1)))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values())) and "__x" in kept.columns


def test_near_duplicates_of_a_star_are_one_class(spark):
    g = np.random.default_rng(3)
    words = [f"w{x}" for x in g.integers(0, 10**6, 400)]
    rows = [(0, " ".join(words))]
    for copy in range(1, 301):
        w = list(words)
        for j in g.choice(np.arange(2, 398, 5), 7, replace=False):
            w[j] = f"c{copy}x{j}"
        rows.append((copy, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    idf = near_dups.idf_table(df)
    sets = [near_dups.weighted_set([t.encode()])[1:] for _, t in rows]
    assert all(near_dups.similarity(sets[0], s, idf) >= 0.8 for s in sets)
    assert np.mean([near_dups.similarity(sets[i], sets[i + 1], idf) >= 0.8 for i in range(1, 300)]) < 0.05
    bands = near_dups.Sampler()
    keys = [bands.bands(np.zeros(len(h), np.int64), h, n * idf[near_dups.bucket_of(h)], 1)[0] for h, n in sets]
    meet = {i for i in range(301) if (keys[i] == keys[0]).any()}
    got = {r["doc_id"]: r["class_id"] for r in near_dups.near_duplicates(df).collect()}
    assert len(meet) > 290 and all(got[i] == 0 for i in meet)


def test_near_duplicates_of_odd_rows(spark):
    got = near_dups.near_duplicates(odd(spark)).collect()
    assert len(got) == 11
    by = {r["doc_id"]: r["class_id"] for r in got}
    assert by[1] == by[2] == by[8] == 1 and by[3] == 3 and by[4] == 4 and by[None] == 4
    assert sorted(r["doc_id"] for r in near_dups.keep_first(odd(spark)).collect()) == [1, 3, 4, 5, 6, 7]
    assert near_dups.keep_first(odd(spark).limit(0)).count() == 0


def test_one_text_of_a_class_stays_whatever_its_ids(spark):
    words = [f"w{i}" for i in range(300)]
    near = [" ".join([*words, f"end{i}"]) for i in range(3)]
    for ids in ((None, None, None), (5, 5, 6), (None, 5, 5)):
        rows = [(i, t, 1, 2, "n", "k") for i, t in zip(ids, near, strict=True)] + [(9, "something else entirely", 1, 2, "n", "k")]
        df = spark.createDataFrame(rows, "doc_id long, text string, node long, Kept_Node int, bucket string, label string")
        kept = near_dups.keep_first(df)
        assert kept.columns == df.columns and kept.count() == 2
        least = min((i for i in ids if i is not None), default=None)
        assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([least, 9], key=str)
        assert near_dups.near_duplicates(df).filter("keep").select("node").distinct().count() == 2


def test_blocks_of_hubs_find_all_links_of_unlike_buckets(spark, monkeypatch):
    # texts that share buckets without being alike settle in many small blocks
    monkeypatch.setattr(near_dups, "BLOCK_BYTES", 3000)
    g = np.random.default_rng(8)
    words = [f"w{x}" for x in g.integers(0, 10**6, 150)]
    rows = []
    for copy in range(80):
        w = list(words)
        for j in g.choice(150, int(g.integers(1, 9)), replace=False):
            w[j] = f"c{copy}x{j}"
        rows.append((copy, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    idf = near_dups.idf_table(df)
    sets = [near_dups.weighted_set([t.encode()])[1:] for _, t in rows]
    sampler = near_dups.Sampler()
    keys = [sampler.bands(np.zeros(len(h), np.int64), h, n * idf[near_dups.bucket_of(h)], 1)[0] for h, n in sets]
    label = list(range(80))
    for i in range(80):
        for j in range(i):
            if (keys[i] == keys[j]).any() and near_dups.similarity(sets[i], sets[j], idf) >= 0.8:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    assert 1 < len(set(label)) < 80
    assert {r["doc_id"]: r["class_id"] for r in near_dups.near_duplicates(df).collect()} == dict(enumerate(label))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in [*range(61), 100, 200, 300]], "node long")
    got = {r[0]: r[1] for r in near_dups.components(nodes, links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100, 300: 300}


def distance(a, b):
    """Least edits between the list ``a`` and any stretch of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_decontamination_against_brute_force(spark):
    g = np.random.default_rng(4)
    vocabulary = [f"v{i}" for i in range(400)]
    pick = lambda n: [vocabulary[i] for i in g.integers(0, 400, n)]
    items = [(i, pick(int(g.integers(12, 40)))) for i in range(15)]
    rows = []
    for d in range(90):
        w = pick(80)
        if d % 3:
            item = list(items[d % 15][1])
            for _ in range(int(g.integers(0, 1 + int(0.3 * len(item))))):
                at = int(g.integers(0, len(item)))
                item[at:at + 1] = [[], pick(1), pick(2)][int(g.integers(0, 3))]
            w[20:20] = item
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(99, None), (98, "v1 v2")], "item_id long, text string")
    got = {r["doc_id"]: set(r["items"]) for r in decontaminate.contamination(docs, benchmark).collect()}
    want = {d: {i for i, w in items if distance(w, t.split()) <= decontaminate.allowed(len(w))} for d, t in rows}
    assert all(got[d] <= want[d] for d in want)  # verified, so never wrong
    found, all_ = sum(map(len, got.values())), sum(map(len, want.values()))
    assert all_ > 40 and found >= 0.97 * all_
    clean = {r["doc_id"] for r in decontaminate.keep_clean(docs, benchmark).collect()}
    assert clean == {d for d, s in got.items() if not s}


def test_decontamination_of_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, "one two three four five"), (1, "one two three four five")], "item_id long, text string")
    rows = odd(spark).unionByName(odd(spark).limit(1).withColumn("doc_id", F.lit(50)).withColumn("text", F.lit("zero One, TWO three four five!")))
    got = {r["doc_id"]: r for r in decontaminate.contamination(rows, benchmark).collect()}
    assert [d for d, r in got.items() if r["contaminated"]] == [50] and got[50]["hits"][0]["start"] == 1
    assert decontaminate.keep_clean(rows, benchmark.limit(0)).count() == rows.count()
    assert decontaminate.keep_clean(rows.limit(0), benchmark).columns == rows.columns


def test_best_stretch_equals_brute_force():
    g = np.random.default_rng(3)
    for _ in range(100):
        a, b = g.integers(0, 4, g.integers(1, 9)), g.integers(0, 4, g.integers(0, 14))
        edits, x, y = decontaminate.best_stretch(a.astype(np.uint64), b.astype(np.uint64))
        assert edits == distance(list(a), list(b))
        assert distance(list(a), list(b[x:y])) == edits


def test_licences(spark):
    files = spark.createDataFrame([
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "foo"), (3, "c/x.py", "foo"),
        (4, "a/b/COPYING", "x\nLicensed under the Apache License, Version 2.0.\n"), (5, "a/b/c/d/y", None), (6, None, "foo"),
        (7, "top", "q"), (8, "a/z", "Licensed under CC BY-NC 4.0.\n" + "foo " * 100), (8, "a/z", "Licensed under CC BY-NC 4.0.\n" + "foo " * 100),
        (9, "a/zz", "the license of a car")], "file_id long, path string, text string")
    got = {r["file_id"]: (r["licence"], r["origin"], r["from_directory"]) for r in licences.licences(files).collect()}
    assert got == {1: ("MIT", "header", None), 2: ("Apache-2.0", "directory", "a/b"), 3: (None, "none", None), 4: ("Apache-2.0", "header", None),
                   5: ("Apache-2.0", "directory", "a/b"), 6: (None, "none", None), 7: (None, "none", None), 8: ("CC-BY-NC-4.0", "header", None),
                   9: ("MIT", "directory", "a")}
    assert licences.licences(files).count() == 10 and licences.licences(files.limit(0)).count() == 0


def test_licences_of_other_versions_and_variants(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n"
    gnu = "it under the terms of the GNU {}General Public License as published by\nthe Free Software Foundation, either version {} of the License, or\n(at your option) any later version."
    cases = [("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("GPL-2.0", gnu.format("", 2)),
             ("GPL-3.0", gnu.format("", 3)), ("LGPL-2.1", gnu.format("Lesser ", 2.1)), ("AGPL-3.0", gnu.format("Affero ", 3)),
             ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\n  Version 2, June 1991\n"), ("CC-BY-3.0", "Creative Commons Attribution 3.0 Unported"),
             (None, "it under the terms of the GNU Lesser General Public License as published by"), ("CC-BY-NC-SA-4.0",
             "This work is licensed under a Creative Commons\nAttribution-NonCommercial-ShareAlike 4.0 International License."),
             ("BSD-2-Clause", bsd + "THIS SOFTWARE IS PROVIDED BY THE AUTHOR ``AS IS''"), ("BSD-3-Clause", bsd + "Neither the name of X\nTHIS SOFTWARE IS PROVIDED BY X"),
             ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted")]
    files = spark.createDataFrame([(i, f"d{i}/x.py", t) for i, (_, t) in enumerate(cases)], "file_id long, path string, text string")
    assert {r["file_id"]: r["licence"] for r in licences.licences(files).collect()} == {i: n for i, (n, _) in enumerate(cases)}


def test_a_notice_does_not_cover_its_neighbour_lines(spark):
    text = "some other words\nLicensed under CC BY-NC 4.0.\nmore other words"
    files = spark.createDataFrame([(1, text), (2, "foo\nReleased under the MIT License.\nbar")], "file_id long, text string")
    got = {r[0]: r[1] for r in files.select("file_id", licences.header_column(F.col("text")).alias("h")).select("file_id", "h.share").collect()}
    assert got == {1: pytest.approx(7 / 13), 2: pytest.approx(5 / 7)}


@pytest.mark.parametrize("weights", [{"a": 5, "b": 3, "c": 2}, {"a": 7, "b": 1, "c": 1, "d": 0.01}, {"a": 1}])
def test_one_period_stays_within_a_block(weights):
    quota = mixing.quotas(weights, 500)
    order = mixing.one_period(quota) * 2
    seen = dict.fromkeys(weights, 0)
    for t, s in enumerate(order, 1):
        seen[s] += 1
        assert all(abs(seen[x] - quota[x] * t / sum(quota.values())) < 1 for x in weights)


def test_mixing_keeps_all_rows_and_shares(spark, docs):
    rows = docs.unionByName(odd(spark).select(*docs.columns))
    weights = {f"src{i}": i + 1 for i in range(20)}
    plan = mixing.schedule(rows, weights, block_rows=2).collect()
    assert sum(r["copies"] for r in plan) == rows.count()
    slots = collections.defaultdict(set)
    for r in plan:
        slots[r["slot"]].add((r["source"], r["block"]))
    assert all(len(x) == 1 for x in slots.values()) and sorted(slots) == list(range(len(slots)))
    blocks = collections.Counter(next(iter(x))[0] for x in slots.values())
    order = [next(iter(slots[t]))[0] for t in range(len(slots))]
    phase = mixing.phases(dict(blocks), {s: weights.get(s, 1) for s in blocks})[0]
    end = max(phase["took"].values()) and sum(phase["took"].values())
    seen = collections.Counter()
    for t, s in enumerate(order[:end], 1):
        seen[s] += 1
        assert all(abs(seen[x] - q * t / phase["period"]) < 1 for x, q in phase["quota"].items())
    out = mixing.mixed(rows)
    assert out.columns == rows.columns and out.count() == rows.count()
    assert mixing.mixed(rows.limit(0)).count() == 0


@pytest.mark.parametrize("weights", [{f"s{i}": 0.5 if i == 0 else 0.0001 if i == 1 else 0.4999 / 18 for i in range(20)},
                                     {f"s{i}": (1 / 3) ** 0.5 if i == 0 else (2 / 57) ** 0.5 for i in range(20)}])
def test_shares_stay_at_the_given_weights_over_many_periods(weights):
    total, left = sum(weights.values()), {s: 40_000 for s in weights}
    seen, t = dict.fromkeys(weights, 0), 0
    for p in mixing.phases(left, weights):
        for s in mixing.one_period(p["quota"]):
            t, seen[s] = t + 1, seen[s] + 1
            if t <= 60_000:
                assert all(abs(seen[x] - w / total * t) < 2 for x, w in weights.items())
    assert seen == left and t == 800_000


def test_mixing_takes_any_number_of_sources(spark):
    rows = spark.createDataFrame([(i, f"t{i}", f"host{i % 700}") for i in range(2_100)], "doc_id long, text string, source string")
    plan = mixing.schedule(rows, block_rows=2).collect()
    assert sorted(r["doc_id"] for r in plan) == list(range(2_100))
    assert sorted({r["slot"] for r in plan}) == list(range(1_400))


def test_differencing_is_tight():
    g = np.random.default_rng(2)
    sizes = g.integers(1, 1000, 400).astype(float)
    shard = sharding.differencing(sizes, 8)
    sums = np.bincount(shard, sizes, 8)
    assert sums.max() - sums.min() <= 4
    assert sharding.differencing(np.array([100.0, 1, 1]), 3)[0] not in sharding.differencing(np.array([100.0, 1, 1]), 3)[1:]


def test_shards(spark, docs):
    rows = docs.unionByName(odd(spark).select(*docs.columns))
    got = sharding.shards(rows, 8).collect()
    text = collections.defaultdict(set)
    for r in rows.collect():
        b = (r["text"] or "").encode()
        text[r["doc_id"], len(b) + 16, zlib.crc32(b)].add(b)
    assert len(got) == rows.count()
    assert all((r["doc_id"], r["size"], r["text_crc32"]) in text for r in got)
    homes = collections.defaultdict(set)
    slots = collections.defaultdict(list)
    for r in got:
        homes[r["size"], r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shards(rows.limit(0)).count() == 0
