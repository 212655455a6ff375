"""Physical-plan helpers: lineage cuts, row numbers, permutations of them, and exact quantiles.

Joins carry no hints: the planner and adaptive execution choose between
broadcast and shuffle from the sides' bytes, and split skewed partitions.
"""

from __future__ import annotations

import math
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpanel.session import checkpoint_dir


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``.

    Survives executor loss (unlike local checkpoints); used before a result
    is reused by many later jobs.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def with_row_index(df: DataFrame, order_cols: list, name: str = "row_idx",
                   n_parts: int | None = None) -> DataFrame:
    """Dense 0-based index in ``order_cols`` order, computed distributed.

    Range-partition + sort within partitions, tag each row with its
    partition and position, checkpoint (so both passes see identical rows),
    count rows per partition (one small action), then add prefix offsets.
    Rows of equal order columns are spread and ordered by a hash of the row,
    so a value that many rows share does not meet in one task.
    """
    spark = df.sparkSession
    n_parts = n_parts or spark.sparkContext.defaultParallelism
    order = [*order_cols, F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    tagged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()))
    counts = sorted((r["_pid"], r["n"]) for r in
                    tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    kv, acc = [], 0
    for pid, n in counts:
        kv += [F.lit(pid), F.lit(acc)]
        acc += n
    offset = F.element_at(F.create_map(*kv), F.col("_pid")) if kv else F.lit(0)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return tagged.withColumn(name, (offset + local).cast("long")).drop("_pid", "_mid")


ROUNDS = 3


def _sides(n: int) -> tuple[int, int]:
    """Two factors near the root of ``n`` whose product is at least ``n`` and as little over as can be."""
    root = max(1, isqrt(n))
    return min(((a, -(-n // a)) for a in range(root, root + 256)), key=lambda ab: (ab[0] * ab[1] - n, ab[0]))


def permuted_index(index: Column, n: int, *keys: Column) -> Column:
    """A permutation of 0..n-1 that the ``keys`` choose, applied to ``index`` by arithmetic alone.

    The number is split into two digits, and each is shifted in turn by a hash of the other (a Feistel
    network over a x b >= n numbers, so a bijection). A result outside 0..n-1 goes through again; such a walk
    meets each of the a x b - n outside numbers at most once, which bounds its steps.
    """
    a, b = _sides(n)

    def once(x: Column) -> Column:
        state = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, F.lit(b)).alias("r"))

        def half(s: Column, r: Column) -> Column:
            left = F.pmod(s["l"] + F.pmod(F.xxhash64(r, s["r"], *keys), F.lit(a)), F.lit(a))
            return F.struct(left.alias("l"), F.pmod(s["r"] + F.pmod(F.xxhash64(r + ROUNDS, left, *keys), F.lit(b)), F.lit(b)).alias("r"))
        return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), state, half, lambda s: s["l"] * b + s["r"])

    over = a * b - n
    first = once(index.cast("long"))
    if not over:
        return first
    return F.aggregate(F.sequence(F.lit(1), F.lit(over)), first, lambda x, _: F.when(x < n, x).otherwise(once(x)))


BINS = 1024
_Target = tuple[str, int]


def _bin(c: Column, lo: float, hi: float, wide: bool) -> Column:
    """Number of the bin of ``c`` among BINS between lo and hi; a wide range is cut on a logarithmic scale."""
    if wide:
        def scale(x):
            return F.signum(x) * F.log1p(F.abs(x))
        low, high = (math.copysign(math.log1p(abs(v)), v) for v in (lo, hi))
        value = scale(c)
    else:
        low, high, value = lo, hi, c
    step = high / BINS - low / BINS
    return F.greatest(F.lit(0), F.least(F.floor((value - low) / step) if step > 0 else F.lit(0), F.lit(BINS - 1))).cast("int")


def order_statistics(df: DataFrame, ranks: dict[str, list[int]], bounds: dict[str, tuple[float, float]]) -> dict[_Target, float]:
    """Values of the given 0-based ranks of each column among its non-null values, exactly.

    ``bounds`` are each column's least and greatest value. Every pass over the rows counts the values of the
    open intervals in BINS bins; the bin that holds a rank, narrowed to its own least and greatest value, is the
    next interval. An interval of one value, or few enough values to be listed, is done. A pass moves at most BINS
    rows per interval to the driver, whatever the number of rows or of different values.
    """
    found: dict[_Target, float] = {}
    open_: dict[tuple[str, float, float, int], list[int]] = {}  # column, least, greatest, values below: ranks
    n_inside: dict[tuple, int | None] = {}

    def settle(c: str, lo: float, hi: float, below: int, n: int | None, wanted: list[int]) -> None:
        if lo == hi:
            found.update({(c, r): lo for r in wanted})
        elif wanted:
            open_[c, lo, hi, below] = wanted
            n_inside[c, lo, hi, below] = n

    for c, wanted in ranks.items():
        settle(c, *bounds[c], 0, None, wanted)
    wide = True
    while open_:
        intervals, sizes = list(open_.items()), dict(n_inside)
        open_.clear()
        n_inside.clear()
        parts = []
        for i, ((c, lo, hi, below), _) in enumerate(intervals):
            listed = (sizes[c, lo, hi, below] or BINS + 1) <= BINS
            v = F.col(c).cast("double")
            parts.append(F.when(v.between(lo, hi), F.struct(
                F.lit(i).alias("i"), (F.lit(0) if listed else _bin(v, lo, hi, wide)).alias("bin"),
                (v if listed else F.lit(None).cast("double")).alias("own"), v.alias("v"))))
        rows = df.select(F.explode(F.array_compact(F.array(*parts))).alias("e")).select("e.*")
        bins: dict[int, list] = {}
        for r in rows.groupBy("i", "bin", "own").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
            bins.setdefault(r["i"], []).append(r)
        for i, ((c, _, _, below), wanted) in enumerate(intervals):
            for r in sorted(bins[i], key=lambda r: r["lo"]):
                settle(c, r["lo"], r["hi"], below, r["n"], [k for k in wanted if below <= k < below + r["n"]])
                below += r["n"]
        wide = False
    return found


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of whole columns (nulls and NaN ignored; none for an empty column)."""
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    s = clean.agg(*[f(c).alias(f"{c}|{k}") for c in cols for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    ranks, bounds = {}, {}
    for c in cols:
        n = s[f"{c}|n"]
        if n:
            places = [p * (n - 1) for p in probs]
            ranks[c] = sorted({f(x) for x in places for f in (math.floor, math.ceil)})
            bounds[c] = (s[f"{c}|lo"], s[f"{c}|hi"])
    value = order_statistics(clean, ranks, bounds)
    out: dict[str, list[float | None]] = {}
    for c in cols:
        out[c] = []
        for p in probs:
            if c not in ranks:
                out[c].append(None)
                continue
            place = p * (s[f"{c}|n"] - 1)
            low, high = math.floor(place), math.ceil(place)
            a, b = value[c, low], value[c, high]
            out[c].append(a if a == b else (high - place) * a + (place - low) * b)
    return out


def exact_group_quantiles(df: DataFrame, group_cols: list, value_col: str, probs: list[float],
                          names: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles per group.

    Equal values are counted first (reduced before the shuffle, spread by
    value), then the exact ``percentile`` runs over the distinct values with
    their counts, so a value that most rows share costs one entry.
    Nulls are ignored. Output: group columns + one column per prob.
    """
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    vals = df.select(*group_cols, F.col(value_col).alias("_v")).filter(F.col("_v").isNotNull())
    counts = vals.groupBy(*group_cols, "_v").agg(F.count(F.lit(1)).alias("_n"))
    q = F.percentile("_v", [float(p) for p in probs], F.col("_n")).alias("_q")
    g = counts.groupBy(*group_cols).agg(q) if group_cols else counts.agg(q)
    return g.select(*group_cols, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
