"""Phrases whose words stand together far more often than apart, by prefix-free parsing.

Parsing: every piece of text is cut into chunks at windows of ``SHORTEST`` = (longest
phrase - 1) words whose hash is a multiple of ``EVERY``. The window ends one chunk
and begins the next, so equal passages give equal chunks wherever they stand, and
every phrase lies inside a chunk. Chunks also begin every ``LONGEST_CHUNK`` words.
The dictionary holds each distinct chunk once, with its frequency.

Counting: a phrase counts in the chunk in which it begins before the overlap with
the next one, so once; each distinct chunk is read once and counts as often as it
occurs. Words are counted first. The most frequent ``KNOWN`` words get numbers of
16 bits per language, so that a phrase of up to four of them is one 64-bit number,
exactly. Then pairs are counted, then phrases of three and four words whose pairs
are all frequent (no longer phrase is more frequent than a part of it): a bit table
of fixed size says which pairs may be. If there are frequent words beyond
``KNOWN``, phrases with such a word are counted as texts in the same way.

Every step is a partial count per task and a sum after a shuffle; no key's rows
meet in one task. Looked-up tables are bounded by ``KNOWN`` and the bit tables.
Score parts that are known words, which may be shared by a large part of the
phrases, come from the look-up, only others are joined.

Defined results: a null text is empty, a null language is ``und``; texts without
words give nothing; repeated rows count each time; an empty table gives no rows;
other columns are not read. Only the characters A to Z are lower-cased. Memory of
a task: about a megabyte of text at a time, or the longest word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import LOWER, SEGMENT, _powers, kth_largest, mix, slices, utf8, written

LONGEST = 4
SHORTEST = LONGEST - 1
EVERY = 16
LONGEST_CHUNK = 64
KNOWN = 200_000
NUMBERS = (1 << 16) - 1
FLUSH = 300_000
FLUSH_CODES = 1_500_000
#: bits of the tables that say which pairs or words may be frequent; a prime, so that a remainder spreads them
BITS = 67_108_859
UNDETERMINED = "und"

WORD, GAP, BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = GAP
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = BREAK
_LOW = (LOWER - 1).astype(np.uint8)


# ---- parsing ---------------------------------------------------------------------------------

def chunks(text: bytes, more: bool = False) -> tuple[list[bytes], int]:
    """Keys of the chunks of ``text`` (number of overlapping words, then the words) and the bytes used up.
    With ``more`` text to come, the chunk at the end is left for later."""
    raw = np.frombuffer(text + b"\n", np.uint8)
    low = _LOW[raw]
    kind = _KIND[low]
    is_word = kind == WORD
    edge = np.flatnonzero(np.diff(is_word, prepend=False))
    starts, ends = edge[::2], edge[1::2]
    n = len(starts)
    if not n:
        return [], len(text)
    piece = np.searchsorted(np.flatnonzero(kind == BREAK), starts)
    up, down = _powers(len(low))
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:len(low)], out=sums[1:])
    word = mix((sums[ends] - sums[starts]) * down[starts])
    first = np.ones(n, bool)
    first[1:] = piece[1:] != piece[:-1]
    if n >= SHORTEST:
        window = np.zeros(n - SHORTEST + 1, np.uint64)
        for k in range(SHORTEST):
            window = window * np.uint64(0xD6E8FEB86659FD93) + word[k:n - SHORTEST + 1 + k]
        inside = piece[SHORTEST - 1:] == piece[:n - SHORTEST + 1]
        first[:n - SHORTEST + 1] |= inside & (mix(window) % np.uint64(EVERY) == 0)
    run = np.flatnonzero(first)
    first |= (np.arange(n) - np.repeat(run, np.diff(np.append(run, n)))) % LONGEST_CHUNK == 0
    begin = np.flatnonzero(first)
    stop = np.append(begin[1:], n)
    piece_end = np.searchsorted(piece, piece[begin], "right")
    tail = np.minimum(piece_end - stop, SHORTEST)
    used = len(text)
    if more and piece[-1] == (kind[:-1] == BREAK).sum():  # the last piece goes on
        # a chunk at the end waits until all words of its overlap are there
        keep = int(((piece[begin] < piece[-1]) | (piece_end - stop >= SHORTEST)).sum())
        used = int(starts[begin[keep]]) if keep < len(begin) else len(text)
        begin, stop, tail = begin[:keep], stop[:keep], tail[:keep]
    last = stop + tail - 1
    plain = np.concatenate([[0], np.cumsum((starts[1:] - ends[:-1] != 1) | (low[ends[:-1]] != 0x20))])
    odd = plain[last] != plain[begin]
    data = low.tobytes()
    marks = [b"%d" % k for k in range(SHORTEST + 1)]
    return [marks[t] + (b" ".join(data[a:b].split()) if o else data[a:b])
            for t, a, b, o in zip(tail.tolist(), starts[begin].tolist(), ends[last].tolist(), odd.tolist(), strict=True)], used


def text_chunks(text: bytes) -> Iterator[list[bytes]]:
    """Keys of the chunks of one text, about a megabyte at a time."""
    at, step = 0, SEGMENT
    while True:
        stop = at + step
        if stop >= len(text):
            yield chunks(text[at:])[0]
            return
        # a stretch ends after a gap, never within a word
        cut = max(text.rfind(b" ", at, stop), text.rfind(b"\t", at, stop), text.rfind(b"\n", at, stop)) + 1
        if cut > at:
            keys, used = chunks(text[at:cut], True)
            if used:
                yield keys
                at, step = at + used, SEGMENT
                continue
        step *= 2


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Counter] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal held
        for lang, c in found.items():
            tails = np.frombuffer(b"".join(k[:1] for k in c), np.uint8) - 0x30
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(c), pa.string()), pa.array(tails.astype(np.int32)),
                 pa.array([k[1:] for k in c], pa.binary()), pa.array(list(c.values()), pa.int64())], ["lang", "tail", "chunk", "n"])
        found.clear()
        held = 0

    for b in slices(batches, "text"):
        runs: dict[str, list[bytes]] = {}
        for lang, text in zip(b.column("lang").to_pylist(), utf8(b.column("text")), strict=True):
            if len(text) > SEGMENT:
                for keys in text_chunks(text):
                    found.setdefault(lang, Counter()).update(keys)
            elif text:
                runs.setdefault(lang, []).append(text)
        for lang, texts in runs.items():  # texts in a row are pieces of their own
            c = found.setdefault(lang, Counter())
            held -= len(c)
            run, size = [], 0
            for t in [*texts, None]:
                if run and (t is None or size + len(t) > SEGMENT):
                    c.update(chunks(b"\n".join(run))[0])
                    run, size = [], 0
                if t is not None:
                    run.append(t)
                    size += len(t) + 1
            held += len(c)
        if held > FLUSH:
            yield from out()
    yield from out()


def dictionary(docs: DataFrame) -> DataFrame:
    """Distinct chunks ``lang, tail, chunk`` of all texts with their frequency ``n``."""
    rows = docs.select(F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.mapInArrow(_dictionary, "lang string, tail int, chunk binary, n long")
            .groupBy("lang", "tail", "chunk").agg(F.sum("n").alias("n")))


# ---- counting --------------------------------------------------------------------------------

def _by_language(b: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """Chunks, overlaps and frequencies of each language of a batch."""
    langs = b.column("lang").dictionary_encode()
    names, index = langs.dictionary.to_pylist(), langs.indices.to_numpy()
    texts = b.column("chunk").to_numpy(zero_copy_only=False)
    tails, n = b.column("tail").to_numpy(), b.column("n").to_numpy()
    for i, lang in enumerate(names):
        mine = np.flatnonzero(index == i)
        yield lang, texts[mine].tolist(), tails[mine], n[mine]


def _layout(texts: list[bytes], tails: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """All words of the chunks, the chunk of each, how many words of it are left from here, and whether it is before the overlap."""
    words = b" ".join(texts).split(b" ")
    lengths = np.array([t.count(b" ") for t in texts], np.int64) + 1
    chunk = np.repeat(np.arange(len(texts)), lengths)
    left = np.cumsum(lengths)[chunk] - np.arange(len(words))
    return words, chunk, left, left > tails[chunk]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, c in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                ["lang", "word", "n"])
        found.clear()

    for b in slices(batches, "chunk"):
        for lang, texts, tails, n in _by_language(b):
            c = found.setdefault(lang, Counter())
            once = []
            for text, tail, times in zip(texts, tails.tolist(), n.tolist(), strict=True):
                own = text.rsplit(b" ", tail)[0] if tail else text
                if times == 1:
                    once.append(own)
                else:
                    for w in own.split(b" "):
                        c[w] += times
            if once:
                c.update(b" ".join(once).split(b" "))
        if sum(map(len, found.values())) > FLUSH:
            yield from out()
    yield from out()


class Numbers:
    """Known words: number of each language, number (from 1) and frequency of each word of it."""

    def __init__(self, rows: list[tuple[str, bytes, int]]):
        self.langs: list[str] = []
        self.words: list[list[bytes]] = []
        self.counts: list[dict[bytes, int]] = []
        self.left_out = False
        for lang, word, n in sorted(rows, key=lambda r: (r[0], -r[2], r[1])):
            if not self.langs or self.langs[-1] != lang:
                self.langs.append(lang)
                self.words.append([])
                self.counts.append({})
            if len(self.words[-1]) == NUMBERS:
                self.left_out = True
                continue
            self.words[-1].append(word)
            self.counts[-1][word] = n
        self.number_of = {lang: i for i, lang in enumerate(self.langs)}
        self._ids: dict[int, dict[bytes, int]] = {}

    def ids(self, lang: int) -> dict[bytes, int]:
        if lang not in self._ids:
            self._ids[lang] = {w: i + 1 for i, w in enumerate(self.words[lang])}
        return self._ids[lang]

    def plain(self) -> tuple[list[str], list[list[bytes]]]:
        """What tasks need, in types that every process knows."""
        return self.langs, self.words

    @classmethod
    def of(cls, langs: list[str], words: list[list[bytes]]) -> Numbers:
        known = cls([])
        known.langs, known.words = langs, words
        known.number_of = {lang: i for i, lang in enumerate(langs)}
        return known

    def text(self, lang: int, code: int) -> str:
        numbers = [code >> s & 0xFFFF for s in (48, 32, 16, 0)]
        return b" ".join(self.words[lang][i - 1] for i in numbers if i).decode()


def _bit(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return table[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1


def _table(bits: DataFrame) -> np.ndarray:
    """Bit table with the positions ``bit`` set, built by Spark: at most BITS / 64 rows reach the driver."""
    rows = bits.groupBy(F.floor(F.col("bit") / 64).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow()
    table = np.zeros(BITS // 64 + 1, np.uint64)
    table[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return table


def _pair_bit(lang, pair):
    """Position of a pair's bit, in numpy or Spark columns: two numbers of 16 bits and the language's."""
    return (pair + lang * (1 << 32)) % BITS


def _grams(numbers, sizes: tuple[int, ...], pairs=None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Numbers.of(*numbers.value)
        table = pairs.value if pairs is not None else None
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for lang, parts in held.items():
                code = np.concatenate([p[0] for p in parts])
                n = np.concatenate([p[1] for p in parts])
                order = np.argsort(code)
                code, n = code[order], n[order]
                at = np.flatnonzero(np.diff(code, prepend=code[:1] - 1))
                code, n = code[at], np.add.reduceat(n, at)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), lang, np.int32)), pa.array(code), pa.array(n)], ["lang", "code", "n"])
            held.clear()
            size = 0

        for b in slices(batches, "chunk"):
            for name, texts, tails, times in _by_language(b):
                lang = known.number_of.get(name)
                if lang is None:
                    continue
                get = known.ids(lang).get
                words, chunk, left, mine = _layout(texts, tails)
                ids = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
                code, ok = ids, ids > 0
                for m in range(2, max(sizes) + 1):
                    if len(ids) < m:
                        break
                    # phrases of m words that begin at each word: the one of m-1 words and one more
                    pair = (ids[m - 2:-1] << 16) | ids[m - 1:]
                    ok = ok[:-1] & (ids[m - 1:] > 0) & (left[:len(ids) - m + 1] >= m)
                    if table is not None:
                        ok = ok.copy()
                        some = np.flatnonzero(ok)
                        ok[some] = _bit(table, _pair_bit(lang, pair[some]))
                    code = (code[:-1] << 16) | ids[m - 1:]
                    if m in sizes:
                        take = np.flatnonzero(ok & mine[:len(ok)])
                        if len(take):
                            held.setdefault(lang, []).append((code[take], times[chunk[take]]))
                            size += len(take)
            if size > FLUSH_CODES:
                yield from out()
        yield from out()
    return run


def _texts(numbers) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Numbers.of(*numbers.value)
        for b in batches:
            langs = b.column("lang").to_pylist()
            names = [known.text(lang, code & 0xFFFFFFFFFFFFFFFF) for lang, code in zip(langs, b.column("code").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([known.langs[i] for i in langs]), pa.array(names), b.column("n")], ["lang", "phrase", "f"])
    return run


def _other_grams(numbers, frequent) -> Callable:
    """Phrases with a word that has no number, as texts; ``frequent`` says which words may be frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = Numbers.of(*numbers.value), frequent.value
        held: dict[str, dict[bytes, int]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                    ["lang", "phrase", "n"])
            held.clear()

        for b in slices(batches, "chunk"):
            for name, texts, tails, times in _by_language(b):
                lang = known.number_of.get(name)
                ids = known.ids(lang) if lang is not None else {}
                words, chunk, left, mine = _layout(texts, tails)
                numbered = np.fromiter(map(ids.__contains__, words), bool, len(words))
                other = np.flatnonzero(~numbered)
                c = held.setdefault(name, {})
                bit = np.fromiter((zlib.crc32(words[i]) % BITS for i in other.tolist()), np.int64, len(other))
                may = numbered.copy()
                may[other] = _bit(table, bit)
                ok, new = may, ~numbered & may
                for m in range(2, LONGEST + 1):
                    if len(words) < m:
                        break
                    ok = ok[:-1] & may[m - 1:] & (left[:len(words) - m + 1] >= m)
                    new = new[:-1] | ~numbered[m - 1:]
                    at = np.flatnonzero(ok & new & mine[:len(ok)])
                    for i, n in zip(at.tolist(), times[chunk[at]].tolist(), strict=True):
                        phrase = b" ".join(words[i:i + m])
                        c[phrase] = c.get(phrase, 0) + n
            if sum(map(len, held.values())) > FLUSH:
                yield from out()
        yield from out()
    return run


def frequencies(docs: DataFrame, least: int, known_words: int = KNOWN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases ``lang, phrase, f`` of 2 to 4 words that occur at least ``least`` times, words ``lang, word, n``
    of all texts, and the known words among them."""
    spark = docs.sparkSession
    parsed = written(dictionary(docs), "phrase-chunks")
    words = written(parsed.mapInArrow(_words, "lang string, word binary, n long")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-words")
    often = words.filter(F.col("n") >= least)
    over = kth_largest(words, "n", known_words + 1)
    rows = often.filter(F.col("n") > over).collect()  # at most known_words
    known = Numbers([(r["lang"], bytes(r["word"]), r["n"]) for r in rows])
    known_table = spark.createDataFrame(
        [(lang, w.decode(), n) for lang, c in zip(known.langs, known.counts, strict=True) for w, n in c.items()],
        "lang string, word string, n long")
    numbers = spark.sparkContext.broadcast(known.plain())

    def counted(sizes: tuple[int, ...], pairs=None) -> DataFrame:
        return written(parsed.mapInArrow(_grams(numbers, sizes, pairs), "lang int, code long, n long")
                       .groupBy("lang", "code").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrase-codes")

    two = counted((2,))
    bits = _table(two.select(_pair_bit(F.col("lang").cast("long"), F.col("code")).alias("bit")))
    longer = counted(tuple(range(3, LONGEST + 1)), spark.sparkContext.broadcast(bits))
    found = two.unionAll(longer).mapInArrow(_texts(numbers), "lang string, phrase string, f long")
    if known.left_out or over >= least:
        may = _table(often.select((F.crc32("word") % BITS).alias("bit")).distinct())
        others = (parsed.mapInArrow(_other_grams(numbers, spark.sparkContext.broadcast(may)), "lang string, phrase binary, n long")
                  .groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least))
        found = found.unionAll(others.select("lang", F.col("phrase").cast("string"), "f"))
    return written(found, "phrases"), words, known_table


# ---- scores ----------------------------------------------------------------------------------

def _joined(words: Column) -> Column:
    return F.concat_ws(" ", words)


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def score_of(a: str, l: str, r: str, scale: int) -> Column:
    """Floor of ``scale * a / (l + r)`` in whole numbers, of any size."""
    return F.expr(f"cast(cast({scale} as decimal(10,0)) * cast({a} as decimal(19,0)) div (cast({l} as decimal(19,0)) + cast({r} as decimal(19,0))) as long)")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, scale: int = 2_000_000, cover: tuple[int, int] = (80, 100),
                 known_words: int = KNOWN) -> DataFrame:
    """The first ``top`` phrases ``lang, rank, phrase, a, l, r, n, score`` of each language: ``a`` occurrences,
    ``l`` and ``r`` of its parts at the lowest-scoring cut, ``n`` words in all, score ``scale * a / (l + r)``."""
    found, words, known = frequencies(docs, least, known_words)
    split = found.withColumn("w", F.split("phrase", " ")).withColumn("m", F.size("w"))
    cuts = split.select("lang", "phrase", "f", "m", "w", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")).select(
        "lang", "phrase", F.col("f").alias("a"), "k", _joined(F.slice("w", F.lit(1), F.col("k"))).alias("first"),
        _joined(F.slice("w", F.col("k") + 1, F.col("m") - F.col("k"))).alias("rest"))
    # words beyond the known ones, and phrases: no key is shared by many of them
    rare = (words.filter(F.col("n") >= least).select("lang", F.col("word").cast("string").alias("part"), F.col("n").alias("f"))
            .join(F.broadcast(known.select("lang", F.col("word").alias("part"))), ["lang", "part"], "left_anti"))
    parts = rare.unionAll(found.select("lang", F.col("phrase").alias("part"), "f"))
    for part, out in (("first", "l"), ("rest", "r")):
        table = known.select("lang", F.col("word").alias(part), F.col("n").alias("quick"))
        cuts = cuts.join(F.broadcast(table), ["lang", part], "left")
        # what is found already needs no partner; a key of its own keeps such rows apart
        key = F.when(F.col("quick").isNull(), F.col(part)).otherwise(F.concat(F.lit("\t"), F.col("phrase"), F.col("k").cast("string")))
        other = parts.select(F.col("lang").alias("other_lang"), F.col("part").alias("other"), F.col("f").alias("slow"))
        cuts = (cuts.withColumn("key", key).join(other, (F.col("lang") == F.col("other_lang")) & (F.col("key") == F.col("other")), "left")
                .withColumn(out, F.coalesce("quick", "slow")).drop("key", "other", "other_lang", "slow", "quick"))
    score = score_of("a", "l", "r", scale)
    cut = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    # the parts of every longer phrase, with its frequency
    spans = F.expr("flatten(transform(sequence(2, m - 1), s -> transform(sequence(1, m - s + 1), i -> concat_ws(' ', slice(w, i, s)))))")
    inside = split.filter("m > 2").select("lang", F.explode(spans).alias("phrase"), F.col("f").alias("longer"))
    rows = (cut.select("lang", "phrase", "a", "cut", F.lit(None).cast("long").alias("longer"))
            .unionAll(inside.select("lang", "phrase", F.lit(None).cast("long"), F.lit(None).cast(cut.schema["cut"].dataType), "longer"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min("cut").alias("cut"), F.max("longer").alias("longer")))
    kept = rows.filter(F.col("longer").isNull() | (_wide("longer") * cover[1] < _wide("a") * cover[0]))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
