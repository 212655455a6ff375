"""Vector codes, token files and phrases against brute force, the library and hand counts."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tillpanel.llm import phrases, registry, token_files, vector_codes
from tillpanel.llm.common import table
from tillpanel.session import scratch_path

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# ---- vector codes ----------------------------------------------------------------------------

def test_equal_average_search_equals_the_full_search():
    rng = np.random.default_rng(5)
    for width in (1, 2, 4, 7):
        for spread in (2, 9, 300):
            parts, book = rng.integers(-spread, spread, (700, width)), rng.integers(-spread, spread, (37, width))
            book[5] = book[3]
            full = ((parts[:, None] - book[None]) ** 2).sum(2)
            index, distance = vector_codes.nearest(parts, book)
            assert (index == full.argmin(1)).all() and (distance == full.min(1)).all()


def brute_codes(rows, parts, entries, rounds):
    kept = sorted(((i, label, [int(np.floor(256 * float(x))) for x in v]) for i, label, v in rows
                   if v is not None and all(x is not None and np.isfinite(x) for x in v)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = -(-len(kept[0][2]) // parts)
    cut = [[(v + [0] * (parts * width))[p * width:(p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = collections.defaultdict(list)
            for c in cut:
                mine[best(c[p], book)[1]].append(c[p])
            books[p] = [[sum(col) // len(mine[i]) for col in zip(*mine[i], strict=True)] if i in mine else e for i, e in enumerate(book)]
    out = []
    for (i, label, _), c in zip(kept, cut, strict=True):
        found = [best(c[p], books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    sums = collections.Counter()
    for _, label, _, e in out:
        sums[label] += e
    return sorted(((i, code, e, sums[label], digest) for i, label, code, e in out), key=str)


def test_vector_codes_equal_brute_force_on_odd_rows(spark):
    rng = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    rows = [(i, None if i % 7 == 0 else i % 3, [float(x) for x in rng.normal(size=10)]) for i in range(60)]
    rows += [(7, 1, rows[7][2]), (None, 2, rows[3][2]), (100, 1, None), (101, 1, [nan] * 10), (102, 1, [inf] + [0.0] * 9),
             (103, 1, [None] + [0.0] * 9), (104, None, [0.0] * 10), (105, 5, [-0.0] * 10), (106, 5, [1e3] * 10)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, label int, embedding array<double>, code string, ints int")
    for parts, entries in ((5, 8), (4, 30), (16, 64)):
        got = vector_codes.compressed(df.repartition(4), parts=parts, entries=entries).collect()
        assert sorted(map(tuple, got), key=str) == brute_codes(rows, parts, entries, 2)


def test_vector_codes_of_empty_and_uneven_tables(spark):
    schema = "vec_id long, label string, embedding array<float>"
    assert vector_codes.compressed(spark.createDataFrame([], schema)).count() == 0
    uneven = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "a", [1.0]), (3, None, [0.5, 0.5]), (4, "b", [])], schema)
    got = {r["vec_id"]: r for r in vector_codes.compressed(uneven, parts=2).collect()}
    assert got[2]["code"] is None and got[4]["error"] is None and got[1]["code"] == "0000" and got[3]["code"] == "0101"
    with pytest.raises(Exception, match="no exact 64-bit"):
        vector_codes.compressed(spark.createDataFrame([(1, "a", [1e30] * 16)], schema)).collect()


def test_label_sums_with_frequent_and_rare_labels(spark):
    rows = [(i, None if i % 2 else i, "00", i) for i in range(3000)]
    got = vector_codes.label_sums(spark.createDataFrame(rows, "vec_id long, label long, code string, error long")).collect()
    odd = sum(i for i in range(3000) if i % 2)
    assert len(got) == 3000 and all(r["label_error"] == (odd if r["vec_id"] % 2 else r["vec_id"]) for r in got)


# ---- token files -----------------------------------------------------------------------------

def test_words_hold_ids_of_every_width():
    rng = np.random.default_rng(1)
    for n in (1, 59, 700, 5000):
        for most in (1, 2, 300, 50_000, 1 << 40, (1 << 60) - 1, (1 << 64) - 1):
            ids = rng.integers(0, most, n, dtype=np.uint64, endpoint=True)
            ids[rng.random(n) < 0.3] = 1
            words, escapes, groups = token_files.pack(ids)
            assert (token_files.unpack(words, escapes, n) == ids).all()
            assert len(escapes) == (ids >> np.uint64(60) > 0).sum() and len(groups) == -(-len(words) // token_files.GROUP)
    assert len(token_files.pack(np.ones(6000, np.uint64))[0]) == 100


def test_any_stretch_of_a_block_decodes_alone_and_damage_is_found():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 1 << 62, 9000, dtype=np.uint64) >> rng.integers(0, 62, 9000, dtype=np.uint64)
    out = token_files.Blocks(3)
    data = b"".join(b + b"\n" for b in [*out.add(7, iter([ids])), *out.rest()])
    block, = token_files.blocks(memoryview(data))
    for _ in range(200):
        a, b = sorted(rng.integers(0, 9001, 2).tolist())
        assert (block.ids(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.blocks(memoryview(data[:-1])))


def test_ids_by_cuts_equal_the_library():
    enc = token_files.Encoder(WORD_BPE)
    assert enc.by_cuts
    texts = ["", "it's 'so' don't ''s \"'s we'll've I'M DON'T o'clock 'r 're", "Ünï Été ÀÉ ß × ÷ a×b", "x\x1cy\x85z \x00\x01", "####  ## # $%&",
             "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "“quoted”, 'é's l'été", "äb ≠ ≠ ﬁ K Σας ΑΣ' 中文字 123४५ ½ ͏e ́",
             "q" * 300 + " " + "é" * 200 + " tail", "'ſ 's 'S", "İstanbul", " \t\r\n", "a b c"]
    random.seed(4)
    alphabet = list("abS tsm'’dlréÀ×0 1,.#\n\t \x0b\x1c\x85\xa0́中“<|>")
    texts += ["".join(random.choices(alphabet, k=random.randrange(60))) for _ in range(4000)]
    want = enc.tok.encode_batch_fast(texts, add_special_tokens=False)
    for text, w, pieces in zip(texts, want, enc.batch([t.encode() for t in texts]), strict=True):
        assert [int(x) for p in pieces for x in p] == w.ids, text
    long = "".join(random.choices(alphabet, k=1_500_000))
    assert [int(x) for p in enc.pieces(long.encode()) for x in p] == enc.tok.encode(long, add_special_tokens=False).ids


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD_BPE)
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    rows += [(-5, "## # ##"), (-4, None), (-3, ""), (10_000, "word 1 " * 60_000), (10_001, "again " * 65_535), (10_002, "x")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, row int").repartition(5)
    path = token_files.write_ids(docs, WORD_BPE, scratch_path(spark, "token-test"), 2)
    got = {r["doc_id"]: r for r in token_files.documents(spark, path).collect()}
    ids = collections.defaultdict(list)
    for r in token_files.read_ids(spark, path).orderBy("part", "at").collect():
        ids[r["doc_id"]] += r["ids"]
    start = 0
    for doc_id, text in sorted(rows):
        want = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        r = got[doc_id]
        assert ids[doc_id] == want and (r["start"], r["n_tokens"]) == (start, len(want))
        assert r["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    assert len(got) == len(rows)


def test_token_files_of_repeated_null_and_no_ids(spark):
    rows = [(1, "b c"), (1, "b c"), (1, "a"), (None, "z"), (None, None), (2, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_files.round_trip(docs, WORD_BPE, 2).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in got) == [
        (False, 1, 2), (False, 1, 3), (False, 1, 3), (False, 2, 2), (True, 0, 1), (True, 0, 2)]
    in_order = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in in_order] == [0, *np.cumsum([r["n_tokens"] for r in in_order]).tolist()[:-1]]
    assert [r["doc_id"] for r in in_order] == [1, 1, 1, 2, None, None]
    assert token_files.round_trip(docs.limit(0), WORD_BPE, 2).count() == 0


# ---- phrases ---------------------------------------------------------------------------------

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_phrases(rows, least, top):
    f = collections.Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 5):
                f.update(("und" if lang is None else lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    n = collections.Counter()
    for (lang, w), c in f.items():
        if len(w) == 1:
            n[lang] += c
    candidates = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    covered = set()
    for (lang, w), c in candidates.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * c >= 80 * f[lang, w[i:i + m]]:
                    covered.add((lang, w[i:i + m]))
    out = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in covered:
            score, _, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                        for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]))


def odd_documents():
    random.seed(9)
    words = ["a", "b", "c", "É", "é", "dé-jà", "x\x1cy", "THE", "the", "z" * 90, "“q”"]
    rows = [(i, "".join(random.choice(words) + random.choice([" ", " ", " ", " ", "  ", "\t", ". ", "\n", "\x0b"]) for _ in range(random.randrange(80))),
             random.choice(["en", "fr", None, "und", ""])) for i in range(150)]
    passage = " ".join(random.choices(words, k=400))
    return rows + [(200 + i, passage, "en") for i in range(9)] + [(300, None, "en"), (None, "a a a a " * 500, "en"), (301, "", None), (302, " . ,", "xx")]


def test_phrases_equal_brute_force(spark):
    rows = odd_documents()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, n long, chunk string").repartition(6)
    want = brute_phrases(rows, 5, 60)
    assert len(want) > 100
    for known in (phrases.KNOWN, 9, 2):
        got = phrases.collocations(docs, 5, 60, known_words=known)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == want
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_chunks_are_prefix_free_and_stretches_do_not_change_them():
    random.seed(2)
    text = " ".join(random.choice(["alpha", "beta", "gamma", "delta", "a", "."]) for _ in range(5000)).encode()
    whole, used = phrases.chunks(text)
    assert used == len(text)
    again, at = [], 0
    while at < len(text):  # in stretches
        stop = text.rfind(b" ", at, at + 900) + 1 if at + 900 < len(text) else len(text)
        keys, used = phrases.chunks(text[at:stop], stop < len(text))
        again += keys
        at += used
    assert again == whole
    passage = b" ".join(random.choice([b"one", b"two", b"six"]) for _ in range(300))
    a, b = (set(phrases.chunks(x + b" " + passage)[0]) for x in (b"before", b"other start of it"))
    assert len(a & b) > 0.7 * len(a)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 9_000_000_000_000_000_001, 9_100_000_000_000_000_007, 9_200_000_000_000_000_001
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(phrases.score_of("a", "l", "r", 2_000_000)).first()[0] == 2_000_000 * a // (left + right)


def test_contract_columns(spark):
    assert [f.dataType.simpleString() for f in registry.op13_phrases(spark, SF).schema] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert registry.op12_token_files(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    got = registry.op11_vector_codes(spark, SF)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got.filter(F.length("code") != 32).count() == 0
