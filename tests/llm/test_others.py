"""WARC round trips, neighbour search, chat transcripts and the pipeline against brute force."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillpanel.llm import chat, mixing, neighbours, near_dups, registry, warc
from tillpanel.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_warc_round_trip(spark):
    long, huge = "z" * 2000, "y" * (17 << 20)
    rows = [(1, "http://a/b c\nü", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", long), (5, "u", long), (6, "u", huge),
            (7, "u", huge), (None, "n", long), (8, "u", "short"), (9, "u", "short"), (5, "u", long), (10, "u", "\r\n\r\nWARC/1.1\r\n\0\0")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    payload = {r[0]: (r[2] or "").encode() for r in rows}
    for r in got:
        b = payload[r["page_id"]]
        assert r["payload_length"] == len(b) and r["payload_digest"] == hashlib.sha1(b).hexdigest()
        want = {4: 5, None: 5, 6: 7}.get(r["page_id"])
        assert r["refers_to"] == want and r["record_type"] == ("revisit" if want else "response")
        assert r["payload"] == (None if want else b)
    assert next(r["target_uri"] for r in got if r["page_id"] == 1) == "http://a/b%20c%0Aü"
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_are_gzip_with_one_member_per_record(spark):
    path = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame([(i, "u", "text %d " % i * 50) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, path, archive_bytes=2000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).collect()
    assert len(files) > 1
    seen = 0
    for f in files:
        data = bytes(f["content"])
        while data:
            z = zlib.decompressobj(31)
            assert z.decompress(data).startswith(b"WARC/1.1\r\n") and z.eof
            data, seen = z.unused_data, seen + 1
    assert seen == 40


def test_reader_works_in_small_steps_and_finds_damage():
    digest = hashlib.sha1(b"payload").hexdigest()
    data = b"".join(warc.record(i, "u", digest, b"payload", None, False, "2000-01-01T00:00:00Z") for i in range(3))
    steps = [data[i:i + 7] for i in range(0, len(data), 7)]
    assert [warc.parse(*warc.read_record(m))["page_id"] for m in warc.read_members(steps)] == [0, 1, 2]
    bad = warc.record(1, "u", "0" * 40, b"payload", None, False, "2000-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(*warc.read_record(next(warc.read_members([bad]))))
    with pytest.raises(ValueError, match="ends within"):
        warc.read_record(next(warc.read_members([data[:40]])))


def test_neighbours_recall_and_odd_vectors(spark):
    g = np.random.default_rng(0)
    x = g.normal(size=(3000, 16)) * g.uniform(0.5, 2, (3000, 1))
    x[100:400] = x[100]
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    bad = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None] + [1.0] * 15), (5080, [1.0]), (None, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("block", F.lit(1))
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 3000, 20)) and all(len(v) == 20 for v in got.values())
    x = x.astype(np.float32).astype(float)
    hit = 0
    for q, found in got.items():
        s = x @ x[q]
        order = sorted((-s[i], i) for i in range(3000) if i != q)[:20]
        hit += len({i for _, i in order} & {i for i, _ in found})
        assert all(abs(s[i] - v) < 1e-9 for i, v in found)
        assert [i for i, _ in found] == [i for i, _ in sorted(found, key=lambda p: (-p[1], p[0]))]
    assert hit >= 0.9 * 20 * len(got)
    assert [r["vec_id"] for r in neighbours.nearest(df, F.col("vec_id") == 100, 3).orderBy("rank").collect()] == [101, 102, 103]


def test_few_vectors_give_all(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "vec_id long, embedding array<float>")
    assert [r["vec_id"] for r in neighbours.nearest(df, F.col("vec_id") == 0, 20).orderBy("rank").collect()] == [1, 2, 3, 4]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert neighbours.nearest(df.limit(1), F.col("vec_id") >= 0).count() == 0


EVENTS = "conv_id long, seq long, kind string, message string, role string, text string"


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [(1, 0, "delta", "a", "user", "he"), (1, 1, "delta", "a", None, "llo"), (1, 2, "delta", "b", "assistant", "bad"),
           (1, 3, "delta", "c", "user", "gone"), (1, 4, "regenerate", "b", None, "go"), (1, 5, "delta", "b", None, "od"),
           (1, 6, "delta", "d", "user", "x"), (1, 7, "edit", "d", None, "new"), (1, 8, "delta", "d", None, "er"), (2, 0, "delta", "a", None, None)]
    events = spark.createDataFrame(log[::-1], EVENTS)
    got = [(r["conv_id"], r["message"], r["role"], r["text"]) for r in chat.fold(events).orderBy("conv_id", "first").collect()]
    assert got == [(1, "a", "user", "hello"), (1, "b", "assistant", "good"), (1, "d", "user", "newer"), (2, "a", "", "")]
    assert chat.fold(events.limit(0)).count() == 0


def test_transcripts_read_back_exactly(spark):
    probe = registry.PROBE
    turns = [(-7, 0, "user", probe), (-7, 1, "assistant", probe), (1, 2, "assistant", "b"), (1, 2, "assistant", "b"), (1, 0, None, None),
             (1, 11, "user:#", "</turn>\n### user: \\"), (None, None, "assistant", "\U0001f600"), (3, 0, "assistant", "l" * 500_000)]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn int, role string, text string, message string")
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(chat.turns_as_events(df))).collect()}
    for c in {t[0] for t in turns}:
        own = sorted(((t[1], t[2] or "", t[3] or "") for t in turns if t[0] == c), key=lambda t: (t[0] is not None, t))
        learned = "".join(t for _, r, t in own if r == "assistant")
        r = got[c]
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(learned)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


def test_damaged_transcript_is_refused():
    d = chat.Digest(1)
    with pytest.raises(ValueError, match="outside"):
        d.add("stray### user: a</turn>\n", None, None)
    with pytest.raises(ValueError, match="within"):
        d.add("### user: a", None, None)


def test_pipeline_stages_keep_their_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        left = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert left <= {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = spark.createDataFrame(out.collect(), docs.schema)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in docs.collect())
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()) == sorted(r["doc_id"] for r in got)


def test_stages_return_a_callers_columns_whatever_their_names(spark):
    names = ["key", "log_weight", "hits", "node", "kept_node", "kept_id", "mix_source", "mix_doc_id", "mix_node", "own_node", "mix_position",
             "__key", "__log_weight", "__hits", "__node", "__nth", "__kept", "__position", "__s", "__d", "__n", "Block", "label", "bucket"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat_ws("-", F.lit(f"own {i}"), "doc_id"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        right = [F.col(c) == F.concat_ws("-", F.lit(f"own {i}"), "doc_id") for i, c in enumerate(names)]
        rows = out.select("doc_id", F.forall(F.array(*right), lambda x: x).alias("ok")).collect()
        assert rows and all(r["ok"] for r in rows), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_slots_of_each_shard_follow_the_mix(spark):
    rows = [(i, f"text number {i}", "en", f"s{min(i % 10, 3)}", 0) for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    place = {r["doc_id"]: r["position"] for r in mixing.schedule(docs).collect()}
    of = {r[0]: r[3] for r in rows}
    shards = collections.defaultdict(dict)
    for r in corpus_pipeline.sharded(spark, corpus_pipeline.mixed(spark, docs, SF).orderBy("doc_id"), SF).collect():
        shards[r["shard"]][r["slot"]] = r["doc_id"]
    assert len(shards) == corpus_pipeline.SHARDS
    counts = collections.Counter(of.values())
    total = sum(n ** 0.5 for n in counts.values())
    early = collections.Counter()
    for slots in shards.values():
        assert sorted(slots) == list(range(len(slots)))
        assert [place[slots[t]] for t in sorted(slots)] == sorted(place[d] for d in slots.values())
        early.update(of[slots[t]] for t in range(len(slots) // 4))
    assert all(abs(early[s] / sum(early.values()) - n ** 0.5 / total) < 0.05 for s, n in counts.items())


def test_distinct_stage_keeps_one_of_each_class(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    classes = {r["class_id"] for r in near_dups.near_duplicates(docs).collect()}
    assert {r["doc_id"] for r in corpus_pipeline.distinct(spark, docs, SF).collect()} == classes
