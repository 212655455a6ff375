"""Quality filter by importance resampling.

Two bag-of-n-grams models are counted over hashed words, pairs of words (within
a run of equal words one pair, whatever the word) and beginnings of words (so
that rare forms of one stem count together): the raw model over every document,
the target model over labelled good documents.
A document's log importance weight is the sum over its n-grams of
``log p_target - log p_raw``; documents are drawn without replacement by
Gumbel top-k, i.e. the k largest ``log weight + Gumbel noise``.

Unless ``k`` is given, it is calibrated: on labelled documents that the target
model has not seen, the cut on noisy keys with the best balanced accuracy is
found, and k is the number of documents at or above it.

Bounds, all documented parameters: at most ``FIT_ROWS`` good documents fit the
target model and at most ``FIT_ROWS`` others calibrate (chosen by hash); the
models are tables of TABLE counts (two hashes of each n-gram). Counting and scoring cover all rows
and all of each text in two passes without a shuffle of texts.

Defined results: null or empty text has weight 0 and no n-grams; null doc_id
gets noise from its text alone; repeated rows get equal keys and share their
fate; ties at the k-th key are all kept; without labels of both kinds
everything is kept; an empty table gives an empty result; other columns of
the documents pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import SEGMENT, Words, kth_largest, slices, text_key, unused, unit_hash, utf8, written

SIZE = 1 << 17
FIT_ROWS = 20_000
SUPPORT, STRONG = 5.0, 1.5
AGAIN = np.uint64(0x5851F42D4C957F2D)
#: lengths, in bytes, of the word beginnings that are n-grams of their own
HEADS = (4, 5, 6)
TABLE = 2 * (2 + len(HEADS)) * SIZE


def features(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Words, pairs of words and beginnings of words, one kind after another (all at once would be five times the
    memory): where its two independent ranges of SIZE buckets begin, the buckets in them and the texts' numbers."""
    w = Words(texts, punctuation=True, heads=HEADS)
    mask = np.uint64(SIZE - 1)

    def buckets(kind: int, h: np.ndarray, owner: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        return 2 * kind * SIZE, (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64), owner

    owner = np.repeat(np.arange(len(texts)), np.diff(w.bounds))
    yield buckets(0, w.hashes, owner)
    pairs, pair_owner = w.shingles(2)
    # a pair within a run of four equal words is one n-gram, whatever the word
    again = np.zeros(len(owner), bool)
    again[:-3] = (w.hashes[3:] == w.hashes[:-3]) & (owner[3:] == owner[:-3])
    for k in (1, 2):
        again[:-3] &= w.hashes[k:k - 3] == w.hashes[:-3]
    longer = np.diff(w.bounds) > 1
    at = np.arange(len(pairs)) + (np.cumsum(longer) - longer)[pair_owner]  # place of a pair's first word
    pairs = np.where(again[at], AGAIN, pairs) if len(at) else pairs
    del owner, again, at
    yield buckets(1, pairs, pair_owner)
    del pairs, pair_owner
    for n, (h, o) in enumerate(w.heads, 2):
        yield buckets(n, h, o)


def evidence(ratio: np.ndarray, start: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Log ratio of each n-gram: the weaker of its two buckets', so that one that only
    shares a bucket with a telling n-gram tells nothing."""
    a, b = ratio[start:start + SIZE][first], ratio[start + SIZE:start + 2 * SIZE][second]
    return np.where(np.abs(a) < np.abs(b), a, b)


def _count(good):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = np.zeros(TABLE, np.int64)
        target = np.zeros(TABLE, np.int64)
        chosen = good.value
        for b in slices(batches, "text", 2 * SEGMENT):
            is_good = np.array([i in chosen for i in b.column("doc_id").to_pylist()], bool)
            for start, *both, owner in features(utf8(b.column("text"))):
                of_good = is_good[owner]
                for at, buckets in zip((start, start + SIZE), both, strict=True):
                    raw[at:at + SIZE] += np.bincount(buckets, minlength=SIZE)
                    target[at:at + SIZE] += np.bincount(buckets[of_good], minlength=SIZE)
        at = np.flatnonzero(raw)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])
    return run


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """``log p_target - log p_raw`` per bucket from (raw, target) counts.

    The target model sees few documents, and the n-grams of one document (or of
    its copies) come and go together. So a bucket counts only where the raw
    model expects ``SUPPORT`` target occurrences and the two differ by a factor
    of ``exp(STRONG)``; elsewhere both models are taken as equal.
    """
    out = np.zeros(counts.shape[1])
    for part in (slice(i * SIZE, (i + 1) * SIZE) for i in range(TABLE // SIZE)):
        raw, target = counts[:, part]
        expected = raw * (target.sum() / max(raw.sum(), 1.0))
        ratio = np.log((target + 0.5) / (expected + 0.5))
        out[part] = np.where((expected >= SUPPORT) & (np.abs(ratio) >= STRONG), ratio, 0.0)
    return out


def _weight(table):
    @F.arrow_udf("double")
    def weight(text: pa.Array) -> pa.Array:
        ratio, out = table.value, []
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        for b in slices([batch], "text", 2 * SEGMENT):
            sums = np.zeros(b.num_rows)
            for start, first, second, owner in features(utf8(b.column("text"))):
                np.add.at(sums, owner, evidence(ratio, start, first, second))
            out.append(sums)
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())
    return weight


def gumbel(*key: Column) -> Column:
    return -F.log(-F.log(unit_hash(F.lit("gumbel"), *key)))


def best_cut(keys: list[tuple[float, bool]]) -> float:
    """The cut on (key, good) with the best balanced accuracy, in the middle of its gap."""
    good = sum(g for _, g in keys)
    bad = len(keys) - good
    if not good or not bad:
        return float("-inf")
    order = sorted(keys)
    best, cut, kept, refused = -1.0, float("-inf"), good, 0
    for i, (x, g) in enumerate(order):
        score = kept / good + refused / bad
        if score > best:
            best, cut = score, (x + order[i - 1][0]) / 2 if i else float("-inf")
        kept, refused = kept - g, refused + (not g)
    return cut


class Resampler:
    """Models fitted on ``docs`` and ``labels``; ``keys`` scores any documents with them."""

    def __init__(self, docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
        spark = docs.sparkSession
        marks = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
                 .agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")).filter(F.col("good").isNotNull()))
        marks = marks.withColumn("h", F.xxhash64(F.lit("fold"), "doc_id"))
        fit = [r[0] for r in marks.filter(F.col("good") & (F.pmod("h", F.lit(2)) == 0)).orderBy("h").limit(fit_rows).select("doc_id").collect()]
        self.held_out = {r[0]: r[1] for r in marks.filter(F.pmod("h", F.lit(2)) == 1).orderBy("h").limit(fit_rows).select("doc_id", "good").collect()}
        good = spark.sparkContext.broadcast(frozenset(fit))
        counts = np.zeros((2, TABLE))
        rows = (docs.select("doc_id", "text").mapInArrow(_count(good), "bucket int, raw long, target long")
                .groupBy("bucket").agg(F.sum("raw"), F.sum("target")).toArrow())
        counts[:, rows.column(0).to_numpy()] = [rows.column(1).to_numpy(), rows.column(2).to_numpy()]
        self.usable = bool(fit)
        self.weight = _weight(spark.sparkContext.broadcast(log_ratio(counts)))

    def keys(self, docs: DataFrame, weight: str = "log_weight", key: str = "key") -> DataFrame:
        """``docs`` with its log weights and keys in columns of these names, which ``docs`` must not have."""
        noise = gumbel(F.col("doc_id"), text_key(F.col("text")))
        return docs.withColumn(weight, self.weight(F.coalesce("text", F.lit("")))).withColumn(key, F.col(weight) + noise)

    def cut(self, scored: DataFrame, k: int | None = None) -> float:
        """The smallest key that is kept."""
        if k is not None:
            return kth_largest(scored, "key", k)
        if not self.usable:
            return float("-inf")
        ids = scored.sparkSession.sparkContext.broadcast(frozenset(self.held_out))

        @F.arrow_udf("boolean")
        def held(doc_id: pa.Array) -> pa.Array:
            return pa.array([i in ids.value for i in doc_id.to_pylist()], pa.bool_())

        # one key for each labelled id, however often its row is repeated
        rows = scored.filter(held("doc_id")).groupBy("doc_id").agg(F.max("key")).collect() if self.held_out else []
        return best_cut([(r[1], bool(self.held_out[r[0]])) for r in rows])


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """``doc_id, log_weight, key, keep`` per row of ``docs``."""
    model = Resampler(docs, labels)
    scored = written(model.keys(docs.select("doc_id", "text")).drop("text"), "quality-keys")
    cut = model.cut(scored, k)
    return scored.select("doc_id", "log_weight", "key", (F.col("key") >= cut).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    model = Resampler(docs, labels)
    scored = written(model.keys(docs.select("doc_id", "text")).select("doc_id", "key"), "quality-keys")
    cut = model.cut(scored, k)
    weight, key = unused(docs, "log_weight", "key")
    return model.keys(docs, weight, key).filter(F.col(key) >= cut).select(*docs.columns)
