"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Law ``bytes``: documents with equal texts form one group, a group never spans
shards, and shard sizes are as near equal as differencing makes them. The
number of things differenced does not grow with the data: groups above a
fixed part of the corpus stay single (there can be at most ``shards x GRAIN``
of them), all other groups are hashed into ``shards x GRAIN`` bundles of about
equal size. Only these bundle sizes come to the driver; the heap repeatedly
takes the two partial partitions with the largest spread and adds them in
opposite order.

Slots are dense per shard without sorting a shard in one task: rows are hashed
into small cells, cell counts give offsets, and ranks are taken within cells.
With a ``position`` column, slots follow it: cells are then stretches of positions.

Defined results: null text has no bytes (size = overhead) and equals the empty
text; null or repeated ``doc_id`` rows are all placed, order among exact
repeats is arbitrary; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import text_key, written

GRAIN = 128
CELL_ROWS = 5_000


def differencing(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every item: multi-way Karmarkar-Karp over ``sizes``."""
    n = len(sizes)
    if n == 0:
        return np.zeros(0, np.int64)
    parts = np.zeros((n, shards), np.float64)  # partial partitions, ascending sums
    parts[:, -1] = sizes
    # slot_of[i][j]: which (child, slot) fed slot j; kept as a merge tree
    heap = [(-float(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    left, right, order = {}, {}, {}
    sums = {i: parts[i] for i in range(n)}
    fresh = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        merged = sums.pop(a) + sums.pop(b)[::-1]
        rank = np.argsort(merged, kind="stable")
        merged = merged[rank]
        left[fresh], right[fresh], order[fresh] = a, b, rank.astype(np.int16)
        sums[fresh] = merged
        heapq.heappush(heap, (-(float(merged[-1] - merged[0])), fresh))
        fresh += 1
    out = np.zeros(n, np.int64)
    stack = [(heap[0][1], np.arange(shards, dtype=np.int16))]
    while stack:
        node, to = stack.pop()  # to[j]: shard of the node's j-th smallest sum
        if node < n:
            out[node] = to[-1]
            continue
        back = np.empty(shards, np.int16)
        back[order.pop(node)] = to
        stack.append((left[node], back))
        stack.append((right[node], back[::-1]))
    return out


def _fingerprint(key: Column) -> Column:
    return F.xxhash64(key)


def shards(docs: DataFrame, n_shards: int = 40, overhead: int = 16, grain: int = GRAIN, position: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of ``docs``; slots in the order of
    the column ``position``, if given."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(docs.select(
        "doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), text_key(F.col("text")).alias("key"),
        (F.col(position) if position else F.lit(None)).cast("long").alias("position")), "shard-rows")
    bundles = n_shards * grain
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    groups = written(groups, "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = groups.filter(F.col("bytes") * bundles > F.lit(total)).select("key", F.col("bytes"))
    large_keys = large.orderBy("key").collect()  # fewer than ``bundles`` can be so large
    spark = docs.sparkSession
    alone = F.broadcast(spark.createDataFrame(
        [(r[0], bundles + i) for i, r in enumerate(large_keys)], "key string, own int"))
    bundle = F.coalesce("own", F.pmod(_fingerprint(F.col("key")), F.lit(bundles)).cast("int"))
    sizes = sorted(tuple(r) for r in groups.join(alone, "key", "left").groupBy(bundle.alias("bundle"))
                   .agg(F.sum("bytes")).collect())
    shard_of = differencing(np.array([s for _, s in sizes], np.float64), n_shards)
    plan = F.broadcast(spark.createDataFrame(
        [(int(b), int(s)) for (b, _), s in zip(sizes, shard_of, strict=True)], "bundle int, shard int"))
    placed = (rows.join(alone, "key", "left").withColumn("bundle", bundle).join(plan, "bundle")
              .select("doc_id", "size", "text_crc32", "shard", "position"))
    n_rows = groups.agg(F.sum("n")).first()[0] or 0
    return with_slots(placed, n_rows, position is not None)


def with_slots(placed: DataFrame, n_rows: int, ordered: bool = False) -> DataFrame:
    """Adds gapless slots per shard; cells of about ``CELL_ROWS`` rows are ranked apart."""
    cells = max(1, n_rows // CELL_ROWS)
    hashed = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells))
    placed = placed.withColumn("cell", F.floor(F.col("position") / CELL_ROWS) if ordered else hashed.cast("long"))
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "cell", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("position", "doc_id", "text_crc32"))
    ranked = placed.withColumn("rank", rank).join(offsets, ["shard", "cell"])
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
