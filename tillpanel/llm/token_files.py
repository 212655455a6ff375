"""Binary files of token ids in Simple-8b words, and their reader.

Ids: every text is cut at white space and at the tokenizer's own pre-token
borders in numpy over whole batches; the tokenizer library encodes each
distinct cut once per task process, and all other occurrences are looked up.
(The tokenizer replaces white space, splits on the rule below and never merges
across a split, so ids of a text are the ids of its cuts in a row.) Words with
characters outside ASCII and the Latin-1 letters are one cut each, which the
library cuts further; texts that may hold an added token go to it whole.

Order: rows are range-partitioned and sorted by (doc_id, hash of the text, row),
so that a doc_id that a third of all rows share still spreads over tasks. A task
streams its rows into blocks of at most ``BLOCK`` ids; a long document runs on
over blocks. Spark's text writer stores the blocks (the line end is the block's
last byte) and starts a new file every ``FILE_BLOCKS`` blocks, so any file
system works and a lost task is redone.

Block, little endian: the header ``HEADER``; per document piece its doc_id (8
bytes), number of ids (4) and flags (1); per group of ``GROUP`` words the number
of ids before it (4); the words (8 each); the escaped ids (8 each); a line end.
A word holds a selector in its high 4 bits and as many ids of equal width as
its selector says; ids of more than 60 bits stand in the escape list, their word
only marks the place. With the per-group offsets any stretch decodes alone, and
all words of one selector decode in one numpy step.

Defined results: a null text is empty; a null doc_id is kept and comes last;
rows with equal doc_id follow the hash of their texts, exact repeats are all
kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import struct
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.llm.common import LOWER, SEGMENT, _pieces, _powers, mix, slices, utf8, written
from tillpanel.session import scratch_path

BLOCK = 1 << 16
FILE_BLOCKS = 128
GROUP = 256
MAGIC = b"S8B1"
HEADER = "<4sIIIIIqqq"  # magic, part, ids, words, escapes, documents, ids of the part before, of the first document before, bytes in all
FIRST, LAST, NO_ID = 1, 2, 4
# fixed values: ids per word and their width for the selectors 2 to 15 of Simple-8b
COUNTS = np.array([0, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 1


# ---- words -----------------------------------------------------------------------------------

def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    out = np.zeros(len(ids), np.uint8)
    rest = ids.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        high = rest >> np.uint64(shift) > 0
        out[high] += np.uint8(shift)
        rest = np.where(high, rest >> np.uint64(shift), rest)
    return out + (rest > 0)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, escaped ids and, for every group of words, the number of ids before it."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    bits = _bits(ids)
    selector = np.full(n, ESCAPE, np.uint8)
    widest = int(bits.max(initial=0))
    for s in range(15, 1, -1):
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        if widest <= width:
            fits = np.ones(n, bool)
        else:
            over = np.zeros(n + 1, np.int32)
            np.cumsum(bits > width, out=over[1:])
            # past the end of the ids a word is filled with zeros
            fits = over[np.minimum(np.arange(n) + count, n)] == over[:-1]
        if not fits.any():
            break
        selector[fits] = s
    step = COUNTS[selector].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    kinds = selector[starts]
    words = kinds.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([ids, np.zeros(60, np.uint64)])
    for s in np.unique(kinds).tolist():
        if s == ESCAPE:
            continue
        mine = np.flatnonzero(kinds == s)
        value = np.zeros(len(mine), np.uint64)
        for k in range(int(COUNTS[s])):
            value |= padded[starts[mine] + k] << np.uint64(k * int(WIDTHS[s]))
        words[mine] |= value
    return words, ids[starts[kinds == ESCAPE]], starts[::GROUP].astype(np.uint32)


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of ``words``; ``escapes`` are the escaped ids among them."""
    kinds = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[kinds]
    ends = np.cumsum(counts)
    out = np.zeros(max(int(ends[-1]) if len(ends) else 0, n), np.uint64)
    starts = ends - counts
    for s in np.unique(kinds).tolist():
        mine = kinds == s
        if s == ESCAPE:
            out[starts[mine]] = escapes
            continue
        if not COUNTS[s]:
            raise ValueError("damaged word in a token file")
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(int(COUNTS[s])):
            out[starts[mine] + k] = (words[mine] >> np.uint64(k * int(WIDTHS[s]))) & mask
    return out[:n]


class Block:
    """One block of a file: document table at once, ids on demand."""

    def __init__(self, data: memoryview, at: int = 0):
        (magic, self.part, self.n_ids, n_words, n_escapes, n_docs, self.before, self.carried, self.size) = struct.unpack_from(HEADER, data, at)
        if magic != MAGIC or self.size > len(data) - at or data[at + self.size - 1] != 0x0A:
            raise ValueError("damaged block in a token file")
        here = at + struct.calcsize(HEADER)

        def column(kind: str, n: int) -> np.ndarray:
            nonlocal here
            out = np.frombuffer(data, kind, n, here)
            here += out.nbytes
            return out

        self.doc_ids, self.lengths, self.flags = column("<i8", n_docs), column("<u4", n_docs), column("u1", n_docs)
        self.groups = column("<u4", -(-n_words // GROUP))
        self.words, self.escapes = column("<u8", n_words), column("<u8", n_escapes)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start:stop`` of the block; only the groups of words that hold them are decoded."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint64)
        first = int(np.searchsorted(self.groups, start, "right")) - 1
        last = int(np.searchsorted(self.groups, stop, "left"))
        words = self.words[first * GROUP:last * GROUP]
        base = int(self.groups[first])
        end = self.n_ids if last >= len(self.groups) else int(self.groups[last])
        skipped = int((self.words[:first * GROUP] >> np.uint64(60) == ESCAPE).sum()) if len(self.escapes) else 0
        taken = int((words >> np.uint64(60) == ESCAPE).sum()) if len(self.escapes) else 0
        return unpack(words, self.escapes[skipped:skipped + taken], end - base)[start - base:stop - base]


def blocks(data: memoryview) -> Iterator[Block]:
    at = 0
    while at < len(data):
        block = Block(data, at)
        yield block
        at += block.size


class Blocks:
    """Collects documents and gives out full blocks (without their last byte, which the writer adds)."""

    def __init__(self, part: int):
        self.part, self.before, self.carried = part, 0, 0
        self._clear()

    def _clear(self) -> None:
        self.parts, self.table, self.held = [], [], 0

    def _take(self) -> bytes:
        ids = np.concatenate(self.parts)
        words, escapes, groups = pack(ids)
        doc_ids = np.array([t[0] for t in self.table], "<i8")
        lengths = np.array([t[1] for t in self.table], "<u4")
        flags = np.array([t[2] for t in self.table], "u1")
        body = b"".join(x.tobytes() for x in (doc_ids, lengths, flags, groups.astype("<u4"), words.astype("<u8"), escapes.astype("<u8")))
        out = struct.pack(HEADER, MAGIC, self.part, len(ids), len(words), len(escapes), len(self.table), self.before, self.carried,
                          struct.calcsize(HEADER) + len(body) + 1) + body
        self.before += len(ids)
        self._clear()
        return out

    def add(self, doc_id: int | None, pieces: Iterator[np.ndarray]) -> Iterator[bytes]:
        """Blocks that fill up while the ids of one document, given in pieces, go in."""
        written_ids, open_piece = 0, 0
        flags = NO_ID if doc_id is None else 0

        def close(more: int) -> None:
            nonlocal written_ids, open_piece
            self.table.append((doc_id or 0, open_piece, flags | (FIRST if written_ids == open_piece else 0) | more))
            open_piece = 0

        for ids in pieces:
            while len(ids):
                if self.held == BLOCK:
                    if open_piece:
                        close(0)
                    yield self._take()
                    self.carried = written_ids
                now = ids[:BLOCK - self.held]
                self.parts.append(now)
                self.held += len(now)
                open_piece += len(now)
                written_ids += len(now)
                ids = ids[len(now):]
        close(LAST)
        if self.held == BLOCK:
            yield self._take()
            self.carried = 0

    def rest(self) -> Iterator[bytes]:
        if self.held:
            yield self._take()


# ---- ids of texts ----------------------------------------------------------------------------

SPACE, LETTER, DIGIT, OTHER, WILD = range(5)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = SPACE
for _lo, _hi, _kind in ((0x30, 0x39, DIGIT), (0x41, 0x5A, LETTER), (0x61, 0x7A, LETTER), (0x80, 0xFF, WILD)):
    _KIND[_lo:_hi + 1] = _kind
_LOW = (LOWER - 1).astype(np.uint8)
LONGEST_CUT = 64
CACHE = 1 << 20
# fixed values: the rule of the pre-tokenizer that the cuts below follow
RULE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def cuts(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of ``text``, starts and ends of its cuts, and whether each is a whole odd word."""
    raw = np.frombuffer(text + b" ", np.uint8)
    low = _LOW[raw]
    kind = _KIND[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    if len(lead):  # Latin-1 letters, without the two signs among them
        after = raw[lead + 1]
        lead = lead[(after != 0x97) & (after != 0xB7)]
        after = raw[lead + 1]
        kind[lead] = kind[lead + 1] = LETTER
        low[lead + 1] = np.where(after < 0x9F, after + 0x20, after)
    new = np.empty(len(raw), bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new |= kind == DIGIT
    quote = np.flatnonzero((low == 0x27) & new & (kind == OTHER))
    if len(quote):  # an apostrophe that begins a cut takes a following s, t, m, d, re, ve or ll with it
        padded = np.concatenate([low, np.zeros(3, np.uint8)])
        one, two = padded[quote + 1], padded[quote + 2]
        length = np.where(np.isin(one, list(b"stmd")), 2, 0)
        length[((one == 0x72) | (one == 0x76)) & (two == 0x65)] = 3
        length[(one == 0x6C) & (two == 0x6C)] = 3
        quote, length = quote[length > 0], length[length > 0]
        new[quote + 1] = False
        new[quote + length] = True
    wild = np.flatnonzero(kind == WILD)
    odd = np.zeros(len(raw), bool)
    if len(wild):  # any other character makes its whole word one cut
        space = kind == SPACE
        gaps = np.flatnonzero(space)
        which = np.unique(np.searchsorted(gaps, wild))
        from_ = np.where(which > 0, gaps[np.maximum(which - 1, 0)] + 1, 0)
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[from_] += 1
        inside[gaps[which]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
        new &= ~inside
        new[from_] = True
        new[gaps[which]] = True
        odd[from_] = True
        low = np.where(inside, raw, low)
        kind = np.where(inside, np.uint8(WILD), kind)
    edges = np.flatnonzero(new)
    ends = np.append(edges[1:], len(raw))
    mine = kind[edges] != SPACE
    return low, edges[mine], ends[mine], odd[edges[mine]]


class Encoder:
    """Ids of texts by a tokenizer file; every distinct cut is encoded once and then looked up."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        steps = (spec.get("normalizer") or {}).get("normalizers") or []
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        added = spec.get("added_tokens") or []
        self.added = [t["content"].encode() for t in added]
        # the cuts hold for this rule only; by other tokenizers every text is encoded whole
        self.by_cuts = ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
                        and steps[1]["pattern"] == {"Regex": "\\s+"} and split.get("pattern") == {"Regex": RULE}
                        and split.get("behavior") == "Removed" and split.get("invert") is True
                        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added))
        self._empty()

    def _empty(self) -> None:
        self.keys, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tok.encode(text.decode(), add_special_tokens=False).ids, np.uint32)

    def _learn(self, keys: np.ndarray, values: list[tuple[bytes, bool]]) -> None:
        """Encodes cuts; an odd word goes through all steps of the library, another cut only through its model."""
        odd = [v.decode() for v, is_odd in values if is_odd]
        odd_ids = iter(self.tok.encode_batch_fast(odd, add_special_tokens=False))
        ids = []
        for value, is_odd in values:
            if is_odd:
                ids.append(next(odd_ids).ids)
                continue
            name = value.decode()
            if not (name.isascii() and name.isprintable()):
                name = self.as_bytes.pre_tokenize_str(name)[0][0]
            ids.append([t.id for t in self.tok.model.tokenize(name)])
        count = np.array([len(x) for x in ids], np.int64)
        first = np.cumsum(count) - count + len(self.pool)
        self.pool = np.concatenate([self.pool, np.fromiter((t for x in ids for t in x), np.uint32, int(count.sum()))])
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys, self.first, self.count = (
            np.concatenate(pair)[order] for pair in ((self.keys, keys), (self.first, first), (self.count, count)))

    def _look_up(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of ``text``, starts of its cuts, and the number of ids up to the end of each cut."""
        if len(self.keys) > CACHE or len(self.pool) > 8 * CACHE:
            self._empty()
        low, starts, ends, odd = cuts(text)
        if not len(starts):
            return np.zeros(0, np.uint32), starts, starts
        up, down = _powers(len(low))
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:len(low)], out=sums[1:])
        lengths = ends - starts
        key = mix((sums[ends] - sums[starts]) * down[starts] + lengths.astype(np.uint64))
        data = low.tobytes()
        for i in np.flatnonzero(lengths > LONGEST_CUT).tolist():  # too long for a hash by a polynomial
            key[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]], digest_size=8).digest(), "little")
        distinct, where, back = np.unique(key, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        if not known.all():
            fresh = np.flatnonzero(~known)
            self._learn(distinct[fresh], [(data[starts[i]:ends[i]], bool(odd[i])) for i in where[fresh].tolist()])
            at = np.searchsorted(self.keys, distinct)
        first, count = self.first[at][back], self.count[at][back]
        upto = np.cumsum(count)
        return self.pool[np.repeat(first - (upto - count), count) + np.arange(int(upto[-1]))], starts, upto

    def pieces(self, text: bytes) -> Iterator[np.ndarray]:
        """Ids of one text, in stretches of about a megabyte."""
        if not self.by_cuts:
            yield self.whole(text)
            return
        slow = any(a in text for a in self.added)
        for part in _pieces(text):
            yield self.whole(part) if slow else self._look_up(part)[0]

    def batch(self, texts: list[bytes]) -> Iterator[Iterator[np.ndarray]]:
        """Ids of several texts; texts are joined by spaces, which no cut crosses, up to a megabyte a look-up."""
        run: list[bytes] = []
        size = 0
        for t in texts:
            if not self.by_cuts or size + len(t) > SEGMENT or any(a in t for a in self.added):
                yield from self._run(run)
                run, size = [], 0
            if not self.by_cuts or len(t) > SEGMENT or any(a in t for a in self.added):
                yield self.pieces(t)
            else:
                run.append(t)
                size += len(t) + 1
        yield from self._run(run)

    def _run(self, texts: list[bytes]) -> Iterator[Iterator[np.ndarray]]:
        if not texts:
            return
        ids, starts, upto = self._look_up(b" ".join(texts))
        borders = np.cumsum([len(t) + 1 for t in texts])
        stops = np.concatenate([[0], upto])[np.searchsorted(starts, borders)]
        at = 0
        for stop in stops.tolist():
            yield iter([ids[at:stop]])
            at = stop


def encoder(path: str) -> Encoder:
    """One encoder a task process, so that its cache serves all tasks of the process. This module's own
    globals come anew with every task, so the encoders are kept in a module of the process."""
    kept = vars(sys.modules.setdefault("tillpanel_encoders", types.ModuleType("tillpanel_encoders")))
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


# ---- files -----------------------------------------------------------------------------------

def _to_blocks(path: str, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = encoder(path), Blocks(TaskContext.get().partitionId())
        end = np.array([end_id], np.uint64)

        def batch(block: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["block"])

        for b in slices(batches, "text"):
            for doc_id, pieces in zip(b.column("doc_id").to_pylist(), enc.batch(utf8(b.column("text"))), strict=True):
                for block in out.add(doc_id, itertools.chain(pieces, (end,))):
                    yield batch(block)
        for block in out.rest():
            yield batch(block)
    return run


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, end_id: int) -> str:
    """Writes the ids of every text of ``docs`` (doc_id, text), each with ``end_id`` after it, below ``path``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc(), F.col("row").asc()]
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(_to_blocks(tokenizer_path, end_id), "block binary")
     .select(F.col("block").cast("string").alias("block"))
     .write.option("lineSep", "\n").option("maxRecordsPerFile", FILE_BLOCKS).text(path))
    return path


def _from_blocks(with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                for block in blocks(memoryview(content.as_buffer())):
                    ids = block.ids()
                    ends = np.cumsum(block.lengths.astype(np.int64))
                    starts = ends - block.lengths
                    documents = starts + block.before
                    documents[0] -= block.carried
                    raw = memoryview(ids.astype("<u4").tobytes())
                    sums = [zlib.crc32(raw[4 * a:4 * e]) for a, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                    arrays = [pa.array(np.full(len(ends), block.part, np.int32)), pa.array(documents), pa.array(starts + block.before),
                              pa.array(block.doc_ids.astype(np.int64), mask=(block.flags & NO_ID) > 0),
                              pa.array(block.lengths.astype(np.int64)), pa.array(block.flags & (FIRST | LAST) == FIRST | LAST),
                              pa.array(sums, pa.int64())]
                    names = ["part", "document", "at", "doc_id", "n", "complete", "crc"]
                    if with_ids:
                        names.append("ids")
                        arrays.append(pa.ListArray.from_arrays(np.append(starts, ends[-1]).astype(np.int32), pa.array(ids.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(arrays, names)
    return run


PIECE = "part int, document long, at long, doc_id long, n long, complete boolean, crc long"


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document piece of the files below ``path``: the writing task's ``part``, where in it the
    ``document`` and the piece (``at``) begin, doc_id, ``n`` ids, whether the document is ``complete``, the
    crc32 of the ids as little-endian 32-bit integers, and the ``ids``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_from_blocks(with_ids), PIECE + (", ids array<long>" if with_ids else ""))


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the one of crc32 (bits reflected: bit 31 is x^0)."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(crcs: list[int], sizes: list[int]) -> int:
    """crc32 of a whole whose parts of ``sizes`` bytes have the crc32 ``crcs``."""
    total = 0
    for crc, size in zip(crcs, sizes, strict=True):
        shift, power, bits = 1 << 31, 1 << 23, size  # x^0; x^8, squared for every bit of the size
        while bits:
            if bits & 1:
                shift = _times(shift, power)
            power, bits = _times(power, power), bits >> 1
        total = _times(shift, total) ^ crc
    return total


def _joined(pieces: list) -> int:
    return joined_crc([p["crc"] for p in pieces], [4 * p["n"] for p in pieces])


def documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document of the files below ``path``."""
    pieces = written(read_ids(spark, path, with_ids=False), "token-pieces")
    whole = pieces.filter("complete").select("part", "document", "doc_id", "n", "crc")
    parts = (pieces.filter("NOT complete").groupBy("part", "document")
             .agg(F.first("doc_id").alias("doc_id"), F.sum("n").alias("n"),
                  F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))
             .select("part", "document", "doc_id", "n", F.udf(_joined, "long")("pieces").alias("crc")))
    # one row per writing task, so a short list
    ends = sorted(tuple(r) for r in pieces.groupBy("part").agg(F.max(F.col("at") + F.col("n"))).collect())
    bases, base = [], 0
    for part, n in ends:
        bases.append((part, base))
        base += n
    bases = F.broadcast(spark.createDataFrame(bases, "part int, base long"))
    return (whole.unionByName(parts).join(bases, "part")
            .select("doc_id", (F.col("base") + F.col("document")).alias("start"), F.col("n").alias("n_tokens"),
                    F.col("crc").alias("ids_crc32")))


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Writes the ids of ``docs`` into the shared folder and returns what reading the files back gives."""
    spark = docs.sparkSession
    return documents(spark, write_ids(docs, tokenizer_path, scratch_path(spark, "token-files"), end_id))
