"""Helpers shared by the training-data operators.

Text is hashed in numpy over whole Arrow batches: words are found by a byte
class table, and a polynomial prefix sum gives every word's 64-bit hash
without a Python loop over words. Memory is bounded by ``SEGMENT`` bytes of
text at a time (a longer text is cut between words), plus eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.session import scratch_path

SEGMENT = 1 << 20
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1

# byte classes: 0 space and control, 1 word (letters, digits, non-ASCII), 2 other punctuation
CLASS = np.full(256, 2, np.uint8)
CLASS[: 0x21] = 0
CLASS[0x7F] = 0
CLASS[0x80:] = 1
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    CLASS[_c] = 1
LOWER = np.arange(256, dtype=np.uint64)
LOWER[0x41:0x5B] += 32
LOWER += 1
_POWERS: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: cuts the
    lineage, survives lost executors, and every later reader sees one set of rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, whatever its letters' case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_key(text: Column) -> Column:
    """128-bit identity of a text (null counts as empty)."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def unit_hash(*cols: Column) -> Column:
    """A repeatable number in (0, 1) from the values of ``cols``."""
    return (F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    if n > len(_POWERS.get("up", ())):
        size = max(n, SEGMENT + 4096)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` cut between words into pieces of about ``SEGMENT`` bytes."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = text.rfind(b" ", at, at + SEGMENT) + 1 or text.find(b" ", at + SEGMENT) + 1 or len(text)
        cut = cut if cut > at else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def _hash_run(buf: np.ndarray, punctuation: bool, heads: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, list]:
    """Hash and start of every word of ``buf`` (which ends with a space); for every length of
    ``heads``, the hashes of the first bytes of the words that have them, and their starts."""
    kind = CLASS[buf]
    if not punctuation:
        kind = kind & 1
    change = np.empty(len(buf), bool)
    change[0] = kind[0] != 0
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    edge = np.flatnonzero(change)
    first = kind[edge] != 0
    starts = edge[first]
    ends = np.append(edge[1:], len(buf))[first]
    up, down = _powers(len(buf))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(LOWER[buf] * up[: len(buf)], out=sums[1:])
    beginnings = []
    for n in heads:
        at = starts[ends - starts >= n]
        beginnings.append((mix((sums[at + n] - sums[at]) * down[at]), at))
    return mix((sums[ends] - sums[starts]) * down[starts]), starts, beginnings


class Words:
    """Word hashes of several texts: ``hashes`` of all, ``bounds[i]:bounds[i+1]`` of text i;
    ``heads``: for every length asked for, hashes of word beginnings and their texts' numbers."""

    def __init__(self, texts: list[bytes], punctuation: bool = False, heads: tuple[int, ...] = ()):
        parts, counts = [], np.zeros(len(texts), np.int64)
        begun: list[tuple[list, list]] = [([], []) for _ in heads]
        run: list[bytes] = []
        owner: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal run, owner, size
            if run:
                lengths = np.array([len(x) + 1 for x in run], np.int64)
                offsets = np.cumsum(lengths) - lengths
                buf = np.frombuffer(b" ".join(run) + b" ", np.uint8)
                h, starts, beginnings = _hash_run(buf, punctuation, heads)
                owners = np.array(owner)
                np.add.at(counts, owners[np.searchsorted(offsets, starts, "right") - 1], 1)
                for (hashes, whose), (x, at) in zip(begun, beginnings, strict=True):
                    hashes.append(x)
                    whose.append(owners[np.searchsorted(offsets, at, "right") - 1])
                parts.append(h)
            run, owner, size = [], [], 0

        for i, t in enumerate(texts):
            for piece in _pieces(t):
                if size + len(piece) > SEGMENT:
                    flush()
                run.append(piece)
                owner.append(i)
                size += len(piece) + 1
        flush()
        self.hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.bounds = np.concatenate(([0], np.cumsum(counts)))
        self.heads = [(np.concatenate(x), np.concatenate(o)) if x else (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for x, o in begun]

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of ``n`` words, and its text's number; a text of
        fewer words is one shingle, a text without words has none."""
        lengths = np.diff(self.bounds)
        count = np.where(lengths > 0, np.maximum(lengths - n + 1, 1), 0)
        owner = np.repeat(np.arange(len(lengths)), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + self.bounds[:-1][owner]
        last = self.bounds[1:][owner]
        short = bool((lengths < n).any())
        out = np.zeros(len(at), np.uint64)
        for k in range(n):
            i = at + k
            if short:
                w = np.where(i < last, self.hashes[np.minimum(i, max(len(self.hashes) - 1, 0))], np.uint64(0))
            else:
                w = self.hashes[i]
            out = out * np.uint64(0xD6E8FEB86659FD93) + w
        return mix(out), owner


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow string column as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = 4 * SEGMENT) -> Iterator[pa.RecordBatch]:
    """``batches`` cut so that each holds about ``limit`` bytes of text, or one row."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = pa.compute.binary_length(b.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                yield b.slice(lo, hi - lo)


BINS = 4096


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value: the range is cut into bins whose counts are
    summed by Spark, and the bin that holds the k-th is cut again."""
    lo, hi, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k >= n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    above = 0  # values over hi
    while lo < hi:
        width = (hi - lo) / BINS
        if lo + width == lo or width == 0:
            break
        bin_of = F.least(F.floor((F.col(column) - lo) / width), F.lit(BINS - 1))
        inside = df.filter(F.col(column).between(lo, hi))
        counts = inside.groupBy(bin_of.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for r in sorted(counts, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                lo, hi = r["lo"], r["hi"]
                break
            above += r["n"]
        if len(counts) == 1 and r["n"] <= 1:
            break
    return lo
