"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its five-word shingles, weight = count x idf. The
idf comes from exact document counts, over all documents, of ``BUCKETS`` hashed
features (a fixed number), so it depends on the share of documents and behaves
alike at every size. Each text gets ``BANDS x ROWS`` consistent samples; texts
that agree on a whole band are candidates, and a candidate pair becomes a link
if its weighted Jaccard similarity, computed from the whole texts, is at least
``threshold``. Classes are the connected components of the links.

Skew: equal texts are collapsed by digest first, with map-side reduction. Two rounds
then compare each text with one hub, so a group of n near copies costs n
comparisons: the hub it shares most buckets with, where a bucket's hub is its
member with the most links so far. After that every bucket that still holds several
components is settled at once: the members outside its most frequent component meet
all members of other components. Both sides are dealt into blocks of about
``BLOCK_BYTES`` of text, and a task compares a block of one side with a block of
the other through an index of shingles, so a bucket costs rows by the number of its
blocks, not of its pairs, and no task holds more than two blocks. Of the links it
finds, a task gives out those that join components. Then each two texts of a bucket are in
one component or were compared.

Recall: a pair at similarity s shares a band with probability
``1-(1-s^ROWS)^BANDS`` (0.998 at 0.8); no bucket, group or partner count is capped.

Defined results: null text counts as empty; all empty texts are copies of each
other; a text without words is only like its copies; a text of fewer than five
words is one shingle; rows of null doc_id take part, and name a class only if
it has no other id (the class is then null); repeated rows are copies, also
those that share an id with another text; of texts with the same smallest id, one
stays; an empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import Words, mix, slices, text_key, unused, utf8, written

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 12, 4
BUCKETS = 1 << 18
#: text of one side that a task holds at a time
BLOCK_BYTES = 8 << 20
HUB_ROUNDS = 2
POOL = 1 << 14
#: idf is 1 for a feature that all documents have and grows by this per factor e of rarity
IDF_SLOPE = 0.05


def weighted_set(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of every distinct shingle, by text and hash."""
    h, owner = Words(texts).shingles(SHINGLE)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def bucket_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for b in slices(batches, "text"):
        total += np.bincount(bucket_of(weighted_set(utf8(b.column("text")))[1]), minlength=BUCKETS)
    at = np.flatnonzero(total)
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])


def idf_table(docs: DataFrame) -> np.ndarray:
    """idf of every feature bucket: 1 + IDF_SLOPE x ln(documents / documents with it)."""
    rows = (docs.select("text").mapInArrow(_document_counts, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n")).toArrow())
    n = docs.select(F.count(F.lit(1))).first()[0]
    df = np.ones(BUCKETS)
    df[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return (1 + IDF_SLOPE * np.log(np.maximum(n / df, 1))).astype(np.float32)


class Sampler:
    """Consistent weighted samples; the random numbers of a shingle come from a fixed pool by its hash."""

    def __init__(self, seed: int = 5):
        g, k = np.random.Generator(np.random.PCG64(seed)), BANDS * ROWS
        self.r = g.gamma(2, 1, (POOL, k)).astype(np.float32)
        self.ln_c = np.log(g.gamma(2, 1, (POOL, k))).astype(np.float32)
        self.beta = g.random((POOL, k), np.float32)

    def bands(self, owner: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """Band keys of ``n`` texts (rows without shingles are to be ignored)."""
        k = BANDS * ROWS
        best = np.full((n, k), np.inf, np.float32)
        sample = np.zeros((n, k), np.uint64)
        for lo in range(0, len(h), 4096):
            o, x = owner[lo:lo + 4096], h[lo:lo + 4096]
            row = (x & np.uint64(POOL - 1)).astype(np.int64)
            r, beta = self.r[row], self.beta[row]
            t = np.floor(np.log(weight[lo:lo + 4096])[:, None] / r + beta)
            a = self.ln_c[row] - r * (t - beta + 1)
            start = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
            least = np.minimum.reduceat(a, start, axis=0)
            local = np.cumsum(np.append(False, o[1:] != o[:-1]))
            i, j = np.nonzero(a == least[local])
            d = o[i]
            # ties (the same pool row) go to the smaller hash, also across blocks of one text
            order = np.argsort(x[i], kind="stable")[::-1]
            i, j, d = i[order], j[order], d[order]
            better = a[i, j] < best[d, j]
            i, j, d = i[better], j[better], d[better]
            sample[d, j] = mix(x[i] + mix(t[i, j].astype(np.int64).view(np.uint64) + np.uint64(1)))
            np.minimum.at(best, (o[start],), least)
        keys = np.zeros((n, BANDS), np.uint64)
        for c in range(ROWS):
            keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + sample[:, c::ROWS])
        return keys


def _sign(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, table = Sampler(), idf.value
        for b in slices(batches, "text"):
            owner, h, count = weighted_set(utf8(b.column("text")))
            keys = sampler.bands(owner, h, count * table[bucket_of(h)], b.num_rows)
            has = np.zeros(b.num_rows, bool)
            has[owner] = True
            sizes = np.where(has, BANDS, 0)
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                                             pa.array(keys[has].ravel().view(np.int64)))
            weight = np.bincount(owner, count * table[bucket_of(h)].astype(np.float64), b.num_rows)
            length = pa.compute.binary_length(b.column("text")).cast(pa.int64()).fill_null(0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("node"), bands, pa.array(weight, pa.float64()), length],
                                             ["doc_id", "node", "bands", "weight", "bytes"])
    return run


def similarity(a: tuple, b: tuple, idf: np.ndarray) -> float:
    """Weighted Jaccard of two (hashes, counts), both ascending."""
    h, at = np.unique(np.concatenate((a[0], b[0])), return_inverse=True)
    w = idf[bucket_of(h)].astype(np.float64)
    x, y = np.bincount(at[:len(a[0])], a[1], len(h)), np.bincount(at[len(a[0]):], b[1], len(h))
    whole = (w * np.maximum(x, y)).sum()
    return float((w * np.minimum(x, y)).sum() / whole) if whole else 0.0


def expanded(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and weight of every shingle of ``texts``; the k-th time a text has a shingle is a
    feature of its own, so that shared weight is a sum over shared features."""
    owner, h, count = weighted_set(texts)
    weight = table[bucket_of(h)].astype(np.float64)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    owner, h, weight = (np.repeat(x, count) for x in (owner, h, weight))
    return owner, np.where(nth > 0, mix(h + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), h), weight


class Hubs:
    """Texts with their labels, held against other texts one by one."""

    def __init__(self, nodes: list[int], labels: list[int], texts: list[bytes], table: np.ndarray, threshold: float):
        self.table, self.threshold = table, threshold
        self.nodes = np.array(nodes, np.int64)
        self.names, self.label = np.unique(np.array(labels, np.int64), return_inverse=True)
        self.merged = {int(x): int(x) for x in self.names}
        owner, h, weight = expanded(texts, table)
        self.total = np.bincount(owner, weight, len(nodes))
        order = np.argsort(h, kind="stable")
        self.owner, h = owner[order], h[order]
        self.features, self.start = np.unique(h, return_index=True)
        self.stop = np.append(self.start[1:], len(h))
        self.weight = weight[order][self.start]

    def root(self, label: int) -> int:
        while self.merged.setdefault(label, label) != label:
            label = self.merged[label]
        return label

    def links(self, nodes: list[int], labels: list[int], minor: list[bool], texts: list[bytes]) -> Iterator[tuple[int, int]]:
        """Pairs (hub, node) that reach the threshold, but those that join nothing new. Two texts outside
        the main component meet twice, and count when the hub is the smaller one."""
        owner, h, weight = expanded(texts, self.table)
        at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
        hit = self.features[at] == h
        total = np.bincount(owner, weight, len(nodes))
        cut = np.searchsorted(owner, np.arange(len(nodes) + 1))
        for i, (node, label, both) in enumerate(zip(nodes, labels, minor, strict=True)):
            u = at[cut[i]:cut[i + 1]][hit[cut[i]:cut[i + 1]]]
            if not len(u):
                continue
            size = self.stop[u] - self.start[u]
            ends = np.cumsum(size)
            where = np.arange(int(ends[-1])) + np.repeat(self.start[u] - (ends - size), size)
            shared = np.bincount(self.owner[where], np.repeat(self.weight[u], size), len(self.nodes))
            like = shared >= (self.threshold - 1e-12) * (self.total + total[i] - shared)
            like &= self.names[self.label] != label
            if both:
                like &= self.nodes < node
            found = np.flatnonzero(like)
            if len(found):
                _, one = np.unique(self.label[found], return_index=True)
                for k in found[one].tolist():
                    a, b = self.root(int(self.names[self.label[k]])), self.root(label)
                    if a != b:
                        self.merged[max(a, b)] = min(a, b)
                        yield int(self.nodes[k]), node


HUB, MEMBER, MINOR = 0, 1, 2


def _compare(idf, threshold: float):
    """Links of groups whose rows come together, hubs first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        group, rows, hubs = None, [], None
        for b in slices(batches, "text"):
            groups = b.column("g").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
            out = []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                part = b.slice(lo, hi - lo)
                side = part.column("side").to_numpy()
                node, label, text = part.column("node").to_pylist(), part.column("label").to_pylist(), utf8(part.column("text"))
                if groups[lo] != group:
                    group, rows, hubs = groups[lo], [], None
                n = int((side == HUB).sum())
                rows += list(zip(node[:n], label[:n], text[:n], strict=True))
                if n < len(node) and rows:
                    if hubs is None:
                        hubs = Hubs(*map(list, zip(*rows, strict=True)), table, threshold)
                    out += hubs.links(node[n:], label[n:], (side[n:] == MINOR).tolist(), text[n:])
            if out:
                a, c = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], ["a", "b"])
    return run


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each connected component of ``links`` (a, b).

    Labels spread along links and are then shortened (a label's own label), so
    long chains need few rounds; each round is a few joins and a written table.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    linked = both.select(F.col("a").alias("node")).distinct()
    labels = written(linked.withColumn("label", F.col("node")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(seen, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = step.join(jump, "label").select("node", F.least("label", "further").alias("label"), "was")
        step = written(step, "labels")
        changed = step.filter(F.col("label") != F.col("was")).limit(1).count()
        labels = step.drop("was")
        if not changed:
            break
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def _block(count: Column) -> Column:
    """Block of a row's node among ``count`` blocks."""
    return F.pmod(F.xxhash64(F.lit("block"), F.col("node")), count)


def _blocks(size: Column) -> Column:
    return F.greatest(F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("long")


def _one_hub_each(members: DataFrame, links: DataFrame | None, threshold: float) -> DataFrame:
    """Groups that compare each text with one hub of another label: of the hubs of its buckets, the one it shares most buckets
    with. A bucket's hub is its member with the most links. ``members``: bucket, node, label, weight, bytes."""
    if links is None:
        ranked = members.withColumn("degree", F.lit(0).cast("long"))
    else:
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
        ranked = members.join(degree, "node", "left").fillna(0, ["degree"])
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "node", "label", "weight")).alias("h"))
    # weighted Jaccard is at most the smaller total weight over the larger
    may = F.least("weight", "h.weight") >= F.greatest("weight", "h.weight") * (threshold - 1e-9)
    met = members.join(hubs, "bucket").filter((F.col("label") != F.col("h.label")) & may)
    shared = met.groupBy("node", F.col("h.node").alias("hub")).agg(
        F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("h.label").alias("hub_label"), F.first("bytes").alias("bytes"))
    chosen = written(shared.groupBy("node").agg(F.max(F.struct("n", "hub", "label", "hub_label", "bytes")).alias("m")).select("node", "m.*"), "hub-pairs")
    blocks = chosen.groupBy("hub", "hub_label").agg(_blocks(F.sum("bytes")).alias("blocks"))
    sides = chosen.join(blocks.drop("hub_label"), "hub").select(
        F.xxhash64("hub", _block(F.col("blocks"))).alias("g"), F.lit(MEMBER).alias("side"), "node", "label")
    each = blocks.select("hub", "hub_label", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"))
    return sides.unionAll(each.select(F.xxhash64("hub", "i"), F.lit(HUB), "hub", "hub_label"))


def _unsettled(members: DataFrame) -> DataFrame:
    """Groups that settle every bucket of several labels: members outside its most frequent label against all others."""
    labels = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    buckets = (labels.groupBy("bucket").agg(F.max(F.struct("n", "label", "bytes")).alias("m"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("parts"))
               .filter("parts > 1").select("bucket", F.col("m.label").alias("main"), _blocks(F.col("bytes") - F.col("m.bytes")).alias("hb"),
                                           _blocks(F.col("bytes")).alias("mb")))
    at = written(members.join(buckets, "bucket").select("bucket", "node", "label", (F.col("label") != F.col("main")).alias("minor"), "hb", "mb"), "unsettled")
    hubs = at.filter("minor").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("mb") - 1))).select(
        F.xxhash64("bucket", _block(F.col("hb")), "i").alias("g"), F.lit(HUB).alias("side"), "node", "label")
    others = at.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("hb") - 1))).select(
        F.xxhash64("bucket", "i", _block(F.col("mb"))), F.when(F.col("minor"), F.lit(MINOR)).otherwise(F.lit(MEMBER)), "node", "label")
    return hubs.unionAll(others)


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``doc_id, node`` per row of ``docs``, and ``node, first_id, class_id, kept`` per distinct text: the
    smallest doc_id of the text's copies and of its whole class, and whether it is the text that the class keeps."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64(text_key(F.col("text"))).alias("node"), "text")
    id_type = texts.schema["doc_id"].dataType.simpleString()
    idf = spark.sparkContext.broadcast(idf_table(docs))
    signed = written(texts.mapInArrow(_sign(idf), f"doc_id {id_type}, node long, bands array<long>, weight double, bytes long"), "signatures")
    nodes = written(signed.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"),
                                               F.first("weight").alias("weight"), F.first("bytes").alias("bytes")), "texts")
    members = nodes.select("node", "weight", "bytes", F.posexplode("bands").alias("band", "value")).select(
        "node", "weight", "bytes", F.xxhash64("band", "value").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    members = written(members.join(shared, "bucket"), "buckets")

    # the texts of candidates, one row each: the copy with the smallest id
    chosen = texts.join(nodes.select(F.col("node").alias("n_"), F.col("first_id").alias("id_")),
                        (F.col("node") == F.col("n_")) & F.col("doc_id").eqNullSafe(F.col("id_"))).select("node", "text")
    found = written(chosen.join(members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "candidate-texts")

    def compared(groups: DataFrame) -> DataFrame:
        rows = groups.join(found, "node").select("g", "side", "node", "label", "text")
        return written(rows.repartition("g").sortWithinPartitions("g", "side").mapInArrow(_compare(idf, threshold), "a long, b long"), "links")

    ends = members.select("node").distinct()
    labelled, links = members.withColumn("label", F.col("node")), None
    for _ in range(HUB_ROUNDS):
        more = compared(_one_hub_each(labelled, links, threshold))
        links = more if links is None else links.unionAll(more)
        labelled = written(members.join(components(ends, links), "node"), "labelled")
    links = links.unionAll(compared(_unsettled(labelled)))

    labels = components(nodes.select("node"), links).join(nodes.select("node", "first_id"), "node")
    first = F.min(F.struct(F.col("first_id").isNull(), F.col("first_id"), F.col("node")))
    names = labels.groupBy("label").agg(F.min("first_id").alias("class_id"), first.alias("first"))
    named = labels.join(names, "label").select("node", "first_id", "class_id", (F.col("node") == F.col("first.node")).alias("kept"))
    return signed.select("doc_id", "node"), named


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, node, class_id, keep`` per row of ``docs``: ``node`` stands for the text, ``class_id``
    is the smallest doc_id of the class, ``keep`` marks that document."""
    rows, named = classes(docs, threshold)
    return rows.join(named, "node").select(
        "doc_id", "node", "class_id", (F.col("kept") & F.col("doc_id").eqNullSafe(F.col("first_id"))).alias("keep"))


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs``, with all its columns, per class: a row of the kept text with its smallest doc_id."""
    node, kept_node, kept_id = unused(docs, "node", "kept_node", "kept_id")
    kept = classes(docs, threshold)[1].filter("kept").select(F.col("first_id").alias(kept_id), F.col("node").alias(kept_node))
    rows = docs.withColumn(node, F.xxhash64(text_key(F.col("text"))))
    same = (F.col(node) == F.col(kept_node)) & F.col("doc_id").eqNullSafe(F.col(kept_id))
    return rows.join(kept, same, "left_semi").dropDuplicates([node]).select(*docs.columns)
