"""Benchmark passages in documents, found by embedding edit distance.

Words (lower-cased, punctuation ignored) are the symbols. A CGK random walk
copies a window of an item's size into a longer string, advancing by a random
bit of each symbol; windows at a small edit distance then agree at most places.
Bit-sampling LSH looks at ``SAMPLED`` places of ``WALKS`` walks in ``TABLES``
tables each, and a window that agrees with an item in one table is verified:
the exact edit distance between the item and the best stretch of the text
around the window must be at most ``rate`` of the item's words.

Windows start where a text holds one of an item's three-word runs, shifted as
that run is in the item. No passage is lost by this: ``floor(rate x m)`` edits
with rate <= 0.2 leave an intact run of three words in any item of m >= 3 words
(m = 5 allows one edit only if a run of three remains). An edit breaks at most
three runs, so texts with fewer of an item's runs than the rest are passed over.

Everything runs inside the scan, without a shuffle or join; items are taken in
blocks of ``BLOCK``, each block one column expression of the same scan.

Defined results: null or empty text holds nothing; items that are null or have
fewer than ``LEAST`` words are not searched for; repeated items are each
reported; an empty benchmark leaves every document clean; a passage of more
than about a megabyte of words in one line is still one text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import SEGMENT, Words, mix, slices, utf8, unused

RATE, LEAST, RUN = 0.2, 3, 3
WALKS, TABLES, SAMPLED = 4, 8, 2
BLOCK = 5_000
PAD = np.uint64(0)
HITS = "array<struct<item_id:{id},start:int,words:int,edits:int>>"


def allowed(m: int, rate: float = RATE) -> int:
    """Edits allowed in an item of ``m`` words; always leaves a run of three intact."""
    k = int(rate * m)
    while k and -(-(m - k) // (k + 1)) < RUN:
        k -= 1
    return k


def walk(words: np.ndarray, start: np.ndarray, m: np.ndarray, seed: int) -> np.ndarray:
    """CGK strings (one row each, 2 x the largest m long) of the windows ``words[start:start+m]``."""
    steps = 2 * int(m.max(initial=1))
    out = np.empty((len(start), steps), np.uint64)
    i = np.zeros(len(start), np.int64)
    last = max(len(words) - 1, 0)
    for j in range(steps):
        at = start + i
        symbol = np.where((i < m) & (at <= last), words[np.minimum(at, last)], PAD)
        out[:, j] = symbol
        i += (mix(symbol ^ np.uint64(0x9E3779B97F4A7C15 * (seed * 100_003 + j + 1) & 0xFFFFFFFFFFFFFFFF)) & np.uint64(1)).astype(np.int64)
    return out


def lsh_keys(words: np.ndarray, start: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Bucket of every window in every table; only windows of one size share buckets."""
    keys = []
    g = np.random.Generator(np.random.PCG64(6))
    places = g.random((WALKS, TABLES, SAMPLED))
    row = np.arange(len(start))
    for s in range(WALKS):
        e = walk(words, start, m, s)
        for t in range(TABLES):
            key = m.astype(np.uint64) + np.uint64(1 + s * TABLES + t << 32)
            for c in range(SAMPLED):
                at = (places[s, t, c] * 2 * m).astype(np.int64)
                key = mix(key * np.uint64(0xD6E8FEB86659FD93) + e[row, at] + at.astype(np.uint64))
            keys.append(key)
    return np.stack(keys, 1) if len(start) else np.zeros((0, WALKS * TABLES), np.uint64)


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance between ``item`` and any stretch of ``text``: (edits, from, to)."""
    n = len(text)
    cost = np.zeros(n + 1, np.int64)
    origin = np.arange(n + 1)
    ramp = np.arange(n + 1)
    for i, w in enumerate(item, 1):
        up = cost + 1                                     # item word left out
        diag = np.empty(n + 1, np.int64)
        diag[0] = i
        diag[1:] = cost[:-1] + (text != w)                # matched or replaced
        came = np.empty(n + 1, np.int64)
        came[0], came[1:] = 0, origin[:-1]
        take = diag <= up
        new, src = np.where(take, diag, up), np.where(take, came, origin)
        # a run of inserted words: the least (new - place) so far decides
        gap = new - ramp
        least = np.minimum.accumulate(gap)
        holder = np.maximum.accumulate(np.where(gap == least, ramp, 0))
        cost, origin = least + ramp, src[holder]
    end = int(np.argmin(cost))
    return int(cost[end]), int(origin[end]), end


class Items:
    """A block of items ready for search."""

    def __init__(self, ids: list, texts: list[str], rate: float = RATE):
        w = Words([t.encode() for t in texts])
        self.ids, self.words, self.start = ids, w.hashes, w.bounds[:-1]
        self.m = np.diff(w.bounds)
        self.allowed = np.array([allowed(int(x), rate) for x in self.m], np.int64)
        self.least = np.maximum(self.m - RUN + 1 - RUN * self.allowed, 1)
        runs, owner = w.shingles(RUN)
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        order = np.argsort(runs, kind="stable")
        self.runs, self.run_item, self.run_place = runs[order], owner[order], place[order]
        # a bitmap turns nearly all words of a text away before the search
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(runs >> np.uint64(42)).astype(np.int64)] = True
        keys = lsh_keys(self.words, self.start, self.m)
        order = np.argsort(keys, axis=0, kind="stable")
        self.key_item, self.keys = order, np.take_along_axis(keys, order, 0)

    def windows(self, runs: np.ndarray, owner: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, start, size) of windows around the runs that items hold.
        ``first``: place of each text's first run."""
        at = np.flatnonzero(self.seen[(runs >> np.uint64(42)).astype(np.int64)])
        lo, hi = np.searchsorted(self.runs, runs[at], "left"), np.searchsorted(self.runs, runs[at], "right")
        n = hi - lo
        at = np.repeat(at, n)
        hit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        text = owner[at]
        # an edit breaks at most RUN runs: fewer hits on an item in the whole text than this rule it out
        pair, count = np.unique(text * len(self.m) + self.run_item[hit], return_inverse=True, return_counts=True)[1:]
        enough = count[pair] >= self.least[self.run_item[hit]]
        at, hit, text = at[enough], hit[enough], text[enough]
        start = np.maximum(at - first[text] - self.run_place[hit], 0)
        return tuple(np.unique(np.stack((text, start, self.m[self.run_item[hit]])), axis=1)) if len(at) else (np.zeros(0, np.int64),) * 3

    def search(self, texts: list[bytes]) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in texts]
        if not len(self.ids):
            return out
        w = Words(texts)
        runs, owner = w.shingles(RUN)
        first = np.searchsorted(owner, np.arange(len(texts)))
        text, start, m = self.windows(runs, owner, first)
        for lo in range(0, len(text), 4096):
            part = slice(lo, lo + 4096)
            self._verify(w, text[part], start[part], m[part], out)
        return out

    def _verify(self, w: Words, text: np.ndarray, start: np.ndarray, m: np.ndarray, out: list[list[dict]]) -> None:
        # a window never reads into the next text: its own words end at its bound
        size = np.minimum(m, w.bounds[1:][text] - w.bounds[:-1][text] - start)
        keys = lsh_keys_within(w.hashes, w.bounds[:-1][text] + start, m, size)
        pairs = set()
        for t in range(keys.shape[1]):
            lo = np.searchsorted(self.keys[:, t], keys[:, t], "left")
            hi = np.searchsorted(self.keys[:, t], keys[:, t], "right")
            for i in np.flatnonzero(hi > lo):
                for item in self.key_item[lo[i]:hi[i], t]:
                    pairs.add((int(i), int(item)))
        for i, item in sorted(pairs):
            d, k, size_ = int(text[i]), int(self.allowed[item]), int(self.m[item])
            if any(h["item_id"] == self.ids[item] and h["start"] <= start[i] + k and start[i] - k <= h["start"] for h in out[d]):
                continue
            a = int(w.bounds[d]) + max(int(start[i]) - k, 0)
            b = min(int(w.bounds[d]) + int(start[i]) + size_ + k, int(w.bounds[d + 1]))
            edits, x, y = best_stretch(self.words[self.start[item]:self.start[item] + size_], w.hashes[a:b])
            if edits <= k:
                out[d].append({"item_id": self.ids[item], "start": a - int(w.bounds[d]) + x, "words": y - x, "edits": edits})


def lsh_keys_within(words: np.ndarray, start: np.ndarray, m: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``lsh_keys`` of windows of size ``m`` of which only ``size`` words exist."""
    short = size < m
    keys = lsh_keys(words, start, m)
    if short.any():
        pick = np.flatnonzero(short)
        for i in pick:
            own = np.concatenate((words[start[i]:start[i] + size[i]], np.zeros(m[i] - size[i], np.uint64)))
            keys[i] = lsh_keys(own, np.zeros(1, np.int64), m[i:i + 1])[0]
    return keys


def _searcher(items, id_type: str):
    @F.arrow_udf(HITS.format(id=id_type))
    def hits(text: pa.Array) -> pa.Array:
        block, out = Items(*items.value), []
        for b in slices([pa.RecordBatch.from_arrays([text], ["text"])], "text", 2 * SEGMENT):
            out += block.search(utf8(b.column("text")))
        kind = pa.int64() if id_type in ("bigint", "int") else pa.string()
        return pa.array(out, pa.list_(pa.struct([("item_id", kind), ("start", pa.int32()), ("words", pa.int32()), ("edits", pa.int32())])))
    return hits


def hits_column(benchmark: DataFrame, text: Column, rate: float = RATE) -> Column:
    """Array of the passages of ``benchmark`` (item_id, text) in ``text``.

    The benchmark comes to the driver in blocks of ``BLOCK`` items; each block
    is one lookup for the tasks, so what a task holds does not grow with it.
    """
    if rate > RATE:
        raise ValueError(f"three-word runs are certain up to a rate of {RATE}")
    spark = benchmark.sparkSession
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    id_type = id_type if id_type in ("bigint", "int") else "string"
    rows = benchmark.select(F.col("item_id").cast(id_type), "text").filter(F.col("text").isNotNull()).orderBy("item_id", "text")
    columns, block = [], []

    def close() -> None:
        keep = [r for r in block if len(Words([r[1].encode()]).hashes) >= LEAST]
        if keep:
            value = ([r[0] for r in keep], [r[1] for r in keep], rate)
            columns.append(_searcher(spark.sparkContext.broadcast(value), id_type)(F.coalesce(text, F.lit(""))))
        block.clear()

    for r in rows.toLocalIterator():
        block.append(r)
        if len(block) == BLOCK:
            close()
    close()
    return F.concat(*columns) if columns else F.array().cast(HITS.format(id=id_type))


def contamination(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id, contaminated, n_items, items, hits`` per row of ``docs``."""
    found = docs.select("doc_id", hits_column(benchmark, F.col("text"), rate).alias("hits"))
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"])))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size(items).alias("n_items"),
                        items.alias("items"), "hits")


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` that hold no passage, with all their columns."""
    hits, = unused(docs, "hits")
    return docs.withColumn(hits, hits_column(benchmark, F.col("text"), rate)).filter(F.size(hits) == 0).select(*docs.columns)
