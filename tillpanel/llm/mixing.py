"""Sources mixed to target weights by Pfair scheduling.

Every source is cut into blocks of ``block_rows`` rows, one block a slot. The
ideal gives each source its exact share of every slot; when a source runs out,
the others share on in proportion. The schedule is cut into periods (of
``period`` slots, or the square root of all slots if that is more), and also
where a source runs out. At each cut a source has the floor or the ceiling of
its ideal number of blocks: what is rounded in one period is carried into the
next, earliest deadline first. Within a period, block i of a source with q
blocks in p slots is released at ``floor(i p / q)`` and due at
``ceil((i + 1) p / q)``; earliest deadline first fills one slot after the
other. So at every slot each source is less than two blocks from its exact
share, however long the schedule, and less than one at each cut.

No row is dropped or repeated and the number of sources is not limited. The
driver holds the counts per source and plans the periods (their number times the
sources); the slots within periods are found by tasks. Ranks within a source are
taken in hashed cells with offsets, so a source that holds a third of all rows is
spread.

Defined results: a null source is a source of its own; sources without a
target weight get the smallest of the given ones, a weight of zero comes last;
null ids and repeated rows are kept (repeats stand side by side); an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import text_key, unused, written

BLOCK_ROWS, PERIOD = 64, 1024
#: float noise of ideal block counts, far below the distance of two of them that matter
NOISE = 1e-7
CELL_ROWS = 2_000


def cuts(blocks: np.ndarray, weights: np.ndarray, period: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First slot and length of every period, and for each source its first block and number of blocks there.

    Sources use up their blocks at ``weight`` blocks a unit of virtual time until they run out, so the ideal
    number of blocks at a slot follows from the virtual time of that slot."""
    weights = np.maximum(weights, weights.max() * 1e-12) if weights.max() > 0 else np.ones(len(weights))
    ends = blocks / weights
    order = np.argsort(ends, kind="stable")
    v = np.concatenate(([0.0], ends[order]))
    rate = np.cumsum(weights[order][::-1])[::-1]
    t = np.concatenate(([0.0], np.cumsum(np.diff(v) * rate)))
    total = int(blocks.sum())
    t *= total / t[-1]
    length = max(period, math.isqrt(total))
    at = np.unique(np.concatenate((np.arange(0, total, length), np.floor(t + NOISE).astype(np.int64), [total])))
    done = np.zeros(len(blocks), np.int64)
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        ideal = np.minimum(blocks, weights * np.interp(hi, t, v)) if hi < total else blocks.astype(float)
        goal = np.maximum(np.floor(ideal + NOISE).astype(np.int64), done)
        need = hi - int(goal.sum())
        # those with a block begun, then (noise only) those with any left, by the end of their next block
        begun = np.ceil(ideal - NOISE) > goal
        for some in (begun, ~begun & (goal < blocks)):
            if need > 0:
                at_most = np.flatnonzero(some & (goal < blocks))
                first = at_most[np.argsort((goal[at_most] + 1) / weights[at_most], kind="stable")][:need]
                goal[first] += 1
                need -= len(first)
        while need:  # noise only
            s = int(np.argmax(np.where(goal > done, goal - ideal, -np.inf))) if need < 0 else int(np.argmax(blocks - goal))
            goal[s] += 1 if need > 0 else -1
            need += -1 if need > 0 else 1
        yield lo, hi - lo, done, goal - done
        done = goal


def quotas(weights: dict, period: int) -> dict:
    """Whole slots of the first period, in proportion to ``weights``."""
    plan = cuts(np.full(len(weights), period, np.int64), np.array([float(w) for w in weights.values()]), period)
    return dict(zip(weights, next(plan)[3].tolist(), strict=True))


def one_period(quota: dict) -> list:
    """Source of every slot: earliest deadline first among released blocks."""
    period = sum(quota.values())
    releases: list[list] = [[] for _ in range(period + 1)]
    for s in sorted(quota, key=str):
        for i in range(quota[s]):
            releases[i * period // quota[s]].append((-(-(i + 1) * period // quota[s]), str(s), i, s))
    ready: list = []
    out = []
    for t in range(period):
        for x in releases[t]:
            heapq.heappush(ready, x)
        out.append(heapq.heappop(ready)[-1])
    return out


def phases(blocks: dict, weights: dict, period: int = PERIOD) -> list[dict]:
    """The periods that use up ``blocks`` (count per source): for each its first slot, length, blocks per
    source, and each source's first block and number of blocks."""
    names = sorted((s for s, n in blocks.items() if n), key=lambda s: (s is not None, str(s)))
    if not names:
        return []
    n, w = np.array([blocks[s] for s in names], np.int64), np.array([float(weights[s]) for s in names])
    return [{"start": lo, "period": length, "quota": (q := dict(zip(names, took.tolist(), strict=True))),
             "first": dict(zip(names, first.tolist(), strict=True)), "took": q} for lo, length, first, took in cuts(n, w, period)]


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start, number, first, took in zip(*(b.column(c).to_pylist() for c in ("start", "number", "first", "took")), strict=True):
            order = np.array(one_period(dict(zip(number, took, strict=True))), np.int64)
            group = np.argsort(order, kind="stable")
            whose = order[group]
            nth = np.arange(len(order)) - np.searchsorted(whose, whose)
            base = np.array(first, np.int64)[np.searchsorted(number, whose)]
            yield pa.RecordBatch.from_arrays([pa.array(whose), pa.array(base + nth), pa.array(start + group)], ["number_", "block_", "slot"])


def schedule(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS, period: int = PERIOD) -> DataFrame:
    """``source, doc_id, node, copies, block, slot, position`` per distinct (source, doc_id, text) of ``docs``;
    ``position`` orders the mix. Without ``weights``, a source weighs the square root of its rows."""
    spark = docs.sparkSession
    keyed = docs.select("source", "doc_id", F.xxhash64(text_key(F.col("text"))).alias("node"))
    rows = written(keyed.groupBy("source", "doc_id", "node").agg(F.count(F.lit(1)).alias("copies")), "mix-rows")
    counts = {r[0]: r[1] for r in rows.groupBy("source").agg(F.count(F.lit(1))).collect()}
    if weights:
        least = min(weights.values())
        target = {s: weights.get(s, least) for s in counts}
    else:
        target = {s: n ** 0.5 for s, n in counts.items()}
    names = sorted(counts, key=lambda s: (s is not None, str(s)))
    source = rows.schema["source"].dataType.simpleString()
    known = F.broadcast(spark.createDataFrame([(s, i, max(1, counts[s] // CELL_ROWS)) for i, s in enumerate(names)],
                                              f"cell_source {source}, number long, cells long"))
    plan = []
    if names:
        blocks = np.array([-(-counts[s] // block_rows) for s in names], np.int64)
        for lo, _, first, took in cuts(blocks, np.array([float(target[s]) for s in names]), period):
            some = np.flatnonzero(took)
            plan.append((lo, some.tolist(), first[some].tolist(), took[some].tolist()))
    spans = spark.createDataFrame(plan, "start long, number array<long>, first array<long>, took array<long>")
    places = spans.mapInArrow(_slots, "number_ long, block_ long, slot long")

    order = F.xxhash64("doc_id", "node")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("cell_source"))).withColumn(
        "cell", F.pmod(F.xxhash64("node", "doc_id"), F.col("cells"))).drop("cell_source", "cells")
    sizes = rows.groupBy(F.col("source").alias("s_"), F.col("cell").alias("c_")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("s_").orderBy("c_").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("s_", "c_", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("source", "cell").orderBy(order, "doc_id", "node"))
    ranked = rows.withColumn("rank", rank).join(offsets, F.col("source").eqNullSafe(F.col("s_")) & (F.col("cell") == F.col("c_")))
    at = F.col("before") + F.col("rank") - 1
    blocked = ranked.withColumns({"block": F.floor(at / block_rows), "within": at % block_rows})
    timed = blocked.join(places, (F.col("number") == F.col("number_")) & (F.col("block") == F.col("block_")))
    return timed.select("source", "doc_id", "node", "copies", "block", "slot",
                        (F.col("slot") * block_rows + F.col("within")).alias("position"))


def placed(docs: DataFrame, weights: dict | None = None, position: str = "__position") -> DataFrame:
    """All rows and columns of ``docs`` and their place in the mix, in a column ``position`` that ``docs`` must not have."""
    source, doc_id, node, own = unused(docs.withColumn(position, F.lit(0)), "mix_source", "mix_doc_id", "mix_node", "own_node")
    plan = schedule(docs, weights).select(F.col("source").alias(source), F.col("doc_id").alias(doc_id), F.col("node").alias(node),
                                          F.col("position").alias(position))
    rows = docs.withColumn(own, F.xxhash64(text_key(F.col("text"))))
    on = F.col("source").eqNullSafe(F.col(source)) & F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(own) == F.col(node))
    return rows.join(plan, on).select(*docs.columns, position)


def mixed(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """All rows and columns of ``docs`` in the order of the mix."""
    position, = unused(docs, "mix_position")
    return placed(docs, weights, position).orderBy(position).drop(position)
