"""Compact vector codes: one codebook per part position, searched by equal averages.

Components become integers, ``floor(scale * x)``, and every vector is cut into
``parts`` equal consecutive parts. A part's nearest codebook entry is found by
its component sum: entries are sorted by their sums, and the search goes
outward from the part's own sum on both sides. For a part and an entry whose
sums differ by g, the squared distance is at least g*g / width, so a side is done
once g*g exceeds width * (best distance so far) strictly; equal bounds are still
looked at, because a tie goes to the lower index. Each step of the search is
one numpy step for all parts of a batch that are still open.

Spark: the integer vectors are written once; a round is one pass whose tasks
return sums and counts per entry (at most parts x entries rows a task), added up
after a shuffle. Only codebooks, whose size is fixed by the parameters, reach
the driver and the tasks. Errors per label are partial sums; the sums of labels
that hold at least a ``HOT``-th of all rows (at most ``HOT`` labels) go to the
tasks as a table, the others join by a shuffle in which no key is frequent.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped. The rows first in order of (vec_id, vector), null ids
last, give the entries, so repeated rows may give equal entries; with fewer rows
there are fewer entries. The first row's length is the vectors' length; rows of
another length keep a null code and error. A length that does not divide evenly
is filled up with zeros. Null labels are one label. Components too large for
exact 64-bit errors raise ValueError. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
HOT = 1000
ROWS = 8192


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of ``book`` for each row of ``parts``; ties to the lower index."""
    width = parts.shape[1]
    sums = book.sum(1)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    own = parts.sum(1)
    best = np.full(len(parts), np.iinfo(np.int64).max // max(width, 1), np.int64)
    index = np.full(len(parts), len(book), np.int64)
    right = np.searchsorted(sums, own)
    sides = [(right - 1, -1), (right.copy(), 1)]
    rows = [np.arange(len(parts)), np.arange(len(parts))]
    while len(rows[0]) or len(rows[1]):
        for side, (at, step) in enumerate(sides):
            open_ = rows[side]
            open_ = open_[(at[open_] >= 0) & (at[open_] < len(book))]
            gap = own[open_] - sums[at[open_]]
            open_ = open_[gap * gap <= best[open_] * width]
            entry = order[at[open_]]
            gap = parts[open_] - book[entry]
            distance = (gap * gap).sum(1)
            better = (distance < best[open_]) | ((distance == best[open_]) & (entry < index[open_]))
            best[open_[better]], index[open_[better]] = distance[better], entry[better]
            at[open_] += step
            rows[side] = open_
    return index, best


def integer_vectors(vectors: DataFrame, vec: str, label: str, scale: int) -> DataFrame:
    """``vec_id, label, ints`` of the rows whose vector has only finite components."""
    finite = F.forall(F.col(vec).cast("array<double>"), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vectors.filter(F.col(vec).isNotNull() & finite).select(
        "vec_id", F.col(label).alias("label"),
        F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("ints"))


def _cut(column: pa.Array, length: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have vectors of ``length``, and these rows as an array (rows, parts, width)."""
    lengths = np.diff(column.offsets.to_numpy())
    fits = lengths == length
    values = column.flatten().to_numpy()
    if not fits.all():
        values = values[np.repeat(fits, lengths)]
    width = -(-length // parts)
    limit = (1 << 28) // max(width, 1)
    if len(values) and (values.max() > limit or values.min() < -limit):
        raise ValueError(f"scaled components beyond {limit} have no exact 64-bit errors")
    out = np.zeros((int(fits.sum()), parts * width), np.int64)
    if length:
        out[:, :length] = values.reshape(-1, length)
    return fits, out.reshape(-1, parts, width)


def _assign(column: pa.Array, books: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    fits, cut = _cut(column, length, len(books))
    index = np.zeros(cut.shape[:2], np.int64)
    distance = np.zeros(cut.shape[:2], np.int64)
    for p, book in enumerate(books):
        index[:, p], distance[:, p] = nearest(np.ascontiguousarray(cut[:, p]), book)
    return fits, cut, index, distance


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def _sums(books: np.ndarray, length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(books.shape, np.int64)
        count = np.zeros(books.shape[:2], np.int64)
        for b in _pieces(batches):
            _, cut, index, _ = _assign(b.column("ints"), books, length)
            for p in range(len(books)):
                np.add.at(total[p], index[:, p], cut[:, p])
                count[p] += np.bincount(index[:, p], minlength=books.shape[1])
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
                 pa.array(list(total[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])
    return run


def _codes(books: np.ndarray, length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexes = np.array([f"{i:02x}" for i in range(books.shape[1])], object)
        for b in _pieces(batches):
            fits, _, index, distance = _assign(b.column("ints"), books, length)
            code = np.full(b.num_rows, None, object)
            code[fits] = ["".join(x) for x in hexes[index]]
            error = np.zeros(b.num_rows, np.int64)
            error[fits] = distance.sum(1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(code, pa.string()), pa.array(error, mask=~fits)],
                ["vec_id", "label", "code", "error"])
    return run


def learn(ints: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray, int]:
    """Codebooks (parts, entries, width) of integer vectors (vec_id, ints), and the vectors' length."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("ints")]
    first = ints.orderBy(*order).limit(1).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64), 0
    length = len(first[0]["ints"])
    same = ints.filter(F.size("ints") == length)
    start = same.orderBy(*order).limit(entries).select("ints").toArrow().column("ints").combine_chunks()
    books = np.ascontiguousarray(_cut(start, length, parts)[1].transpose(1, 0, 2))
    width = books.shape[2]
    for _ in range(rounds):
        sums = ints.select("ints").mapInArrow(_sums(books, length), "part int, entry int, n long, sums array<long>")
        moved = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)))
        books = books.copy()
        for r in moved.collect():  # at most parts x entries rows
            books[r["part"], r["entry"]] = [r[f"s{j}"] // r["n"] for j in range(width)]
    return books, length


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def label_sums(coded: DataFrame) -> DataFrame:
    """``coded`` (with label and error) with the error summed over equal labels, nulls together."""
    spark = coded.sparkSession
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    n = coded.count()
    hot = labels.filter(F.col("n") * HOT >= n).select(F.col("label").alias("hot"), F.col("label_error").alias("hot_error"))
    rows = hot.collect()  # at most HOT labels are so frequent
    table = F.broadcast(spark.createDataFrame(rows, hot.schema).withColumn("is_hot", F.lit(True)))
    found = coded.join(table, F.col("label").eqNullSafe(F.col("hot")), "left")
    common = found.filter("is_hot").select(*coded.columns, F.col("hot_error").alias("label_error"))
    if len(rows) == labels.count():
        return common
    rare = found.filter("is_hot IS NULL").select(*coded.columns)
    others = labels.filter(F.col("n") * HOT < n).select(F.col("label").alias("other"), "label_error")
    return common.unionByName(rare.join(others, F.col("label").eqNullSafe(F.col("other"))).drop("other"))


def codes(vectors: DataFrame, vec: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` per kept row of ``vectors``, and the final codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    ints = written(integer_vectors(vectors, vec, label, scale), "integer-vectors")
    books, length = learn(ints, parts, entries, rounds)
    kinds = {f.name: f.dataType.simpleString() for f in ints.schema}
    coded = ints.mapInArrow(_codes(books, length), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    return written(coded, "vector-codes"), books


def decode(code: str, books: np.ndarray) -> list[int]:
    """The integer vector that a code stands for."""
    return [int(x) for p, book in enumerate(books) for x in book[int(code[2 * p:2 * p + 2], 16)]]


def compressed(vectors: DataFrame, **parameters) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per kept row of ``vectors``."""
    coded, books = codes(vectors, **parameters)
    return label_sums(coded).select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
