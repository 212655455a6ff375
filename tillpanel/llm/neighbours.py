"""Nearest neighbours by inner product: NN-descent graph and greedy search.

Graph. Vectors are lifted by one component so that all have the same norm; the
order by inner product is then the order by distance. Equal vectors are one
node. Starting lists come from random hyperplane leaves of bounded size; then
rounds of NN-descent improve them: every node introduces its neighbours and
reverse neighbours to each other (a join of the edges with both ends'
vectors), and pairs nearer than what they have replace it, until few lists
change.

Search. Each query holds a pool of the nearest nodes found. Rounds of joins
expand its best unexpanded nodes along graph edges, both ways, until the best
``BEAM`` of every pool are expanded. The last pools are scored again in double
precision on the original vectors.

Nodes live in hashed blocks of about ``BLOCK`` vectors, and all work is grouped
by block: a task holds a block and what is sent to it, whatever the corpus
size. All rows are indexed, none is sampled; copies of one vector, however
many, are one node that remembers its ``k + 1`` smallest ids.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, nor do rows of null id;
repeated rows count once; queries with fewer candidates than ``k`` get all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import written

BLOCK = 2000
NEIGHBOURS, SAMPLE = 40, 20
LEAF, TREES = 400, 8
BEAM, STEP, POOL = 176, 32, 208
LISTS = "block int, node long, nbr binary, sim binary, fresh binary"


def clean(embeddings: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the vectors that take part, once each."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))
        & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return rows.filter(F.size("embedding") == (sizes[0]["d"] if sizes else 0)).dropDuplicates(["vec_id"])


def _floats(column, kind, width: int = 0) -> np.ndarray:
    flat = np.frombuffer(b"".join(column), kind)
    return flat.reshape(-1, width) if width else flat


def _lists(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and how many each row has."""
    size = np.dtype(kind).itemsize
    return _floats(column, kind), np.array([len(x) // size for x in column], np.int64)


def _best(u, w, s, f, k: int):
    """The k nearest distinct ``w`` of each ``u``; what was known before keeps its flag."""
    order = np.lexsort((f, w, u))
    u, w, s, f = u[order], w[order], s[order], f[order]
    first = np.ones(len(u), bool)
    first[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
    u, w, s, f = u[first], w[first], s[first], f[first]
    order = np.lexsort((w, -s, u))
    u, w, s, f = u[order], w[order], s[order], f[order]
    start = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, np.int64)
    rank = np.arange(len(u)) - np.repeat(start, np.diff(np.append(start, len(u))))
    keep = rank < k
    return u[keep], w[keep], s[keep], f[keep]


def _cut(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    return [values[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]


def _list_rows(u, w, s, f) -> pd.DataFrame:
    bounds = np.append(np.flatnonzero(np.append(True, u[1:] != u[:-1])), len(u)) if len(u) else np.zeros(1, np.int64)
    nodes = u[bounds[:-1]]
    return pd.DataFrame({"block": (nodes >> 32).astype(np.int32), "node": nodes, "nbr": _cut(w, bounds),
                         "sim": _cut(s.astype(np.float32), bounds), "fresh": _cut(f.astype(np.uint8), bounds)})


def _to_blocks(of: np.ndarray, name: str, columns: dict[str, np.ndarray]) -> pd.DataFrame:
    """One row per target block with its share of ``columns`` as bytes."""
    order = np.argsort(of, kind="stable")
    of = of[order]
    bounds = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of)) if len(of) else np.zeros(1, np.int64)
    return pd.DataFrame({name: of[bounds[:-1]].astype(np.int32)} | {c: _cut(v[order], bounds) for c, v in columns.items()})


PROPOSED = "block int, u binary, w binary, s binary"


class Graph:
    """The neighbour graph of the vectors of ``rows`` (from :func:`clean`)."""

    def __init__(self, rows: DataFrame, copies: int, k: int = NEIGHBOURS, seed: int = 3):
        self.k, self.seed = k, seed
        nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
        few = rows.withColumn("n", nth).filter(F.col("n") <= copies)
        classes = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
        stats = rows.select(norm.alias("q"), F.size("embedding").alias("d")).agg(
            F.max("q"), F.max("d"), F.count(F.lit(1))).first()
        self.most, self.width = float(stats[0] or 0.0), (stats[1] or 0) + 1
        self.blocks = max(1, -(-stats[2] // BLOCK))
        width, most = self.width, self.most

        def number(key, part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("first").reset_index(drop=True)
            x = np.stack(part["embedding"].to_list()) if len(part) else np.zeros((0, width - 1))
            lift = np.sqrt(np.maximum(most - (x * x).sum(1), 0.0))
            v = np.concatenate((x, lift[:, None]), 1).astype(np.float32)
            return pd.DataFrame({"block": np.int32(key[0]), "node": (np.int64(key[0]) << 32) + np.arange(len(part)),
                                 "vec": [r.tobytes() for r in v], "ids": part["ids"]})

        block = F.pmod(F.xxhash64("embedding"), F.lit(self.blocks)).cast("int")
        self.nodes = written(classes.withColumn("first", F.col("ids")[0]).groupBy(block.alias("block"))
                             .applyInPandas(number, "block int, node long, vec binary, ids array<long>"), "nodes")
        self.vectors = self.nodes.select("block", "node", "vec")
        self.lists = self._leaves()

    def _leaves(self) -> DataFrame:
        """First lists: the nearest within random hyperplane leaves."""
        width, k, n = self.width, self.k, max(1, self.blocks * BLOCK)
        bits = max(0, int(np.ceil(np.log2(max(1, n / LEAF)))))
        planes = np.random.Generator(np.random.PCG64(self.seed)).normal(size=(TREES, bits, width)).astype(np.float32)

        def codes(parts):
            for p in parts:
                x = _floats(p["vec"], np.float32, width)
                for t in range(TREES):
                    sides = x @ planes[t].T > 0 if bits else np.zeros((len(x), 0), bool)
                    code = sides @ (1 << np.arange(bits)) if bits else np.zeros(len(x), np.int64)
                    yield pd.DataFrame({"tree": np.int32(t), "code": code.astype(np.int64), "node": p["node"], "vec": p["vec"]})

        coded = written(self.vectors.mapInPandas(codes, "tree int, code long, node long, vec binary"), "leaves")
        sizes = coded.groupBy("tree", "code").agg(F.count(F.lit(1)).alias("n"))
        # a leaf of many alike vectors is split, so that no task compares more than 2 x LEAF with each other
        leaf = coded.join(sizes, ["tree", "code"]).withColumn(
            "part", F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("n") / (2 * LEAF))))

        def nearest(part: pd.DataFrame) -> pd.DataFrame:
            x, node = _floats(part["vec"], np.float32, width), part["node"].to_numpy()
            s = x @ x.T
            np.fill_diagonal(s, -np.inf)
            m = min(k, len(node) - 1)
            if m < 1:
                return pd.DataFrame({"block": [], "u": [], "w": [], "s": []})
            top = np.argpartition(-s, m - 1, axis=1)[:, :m]
            u = np.repeat(node, m)
            return _to_blocks(u >> 32, "block", {"u": u, "w": node[top].ravel(), "s": np.take_along_axis(s, top, 1).ravel().astype(np.float32)})

        found = leaf.groupBy("tree", "code", "part").applyInPandas(nearest, PROPOSED)
        empty = self.vectors.select("block", "node", F.lit(b"").alias("nbr"), F.lit(b"").alias("sim"), F.lit(b"").alias("fresh"))
        return written(self._merged(empty, found), "graph")

    def _merged(self, lists: DataFrame, proposed: DataFrame) -> DataFrame:
        k = self.k

        def merge(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
            w, n = _lists(old["nbr"], np.int64)
            u = np.repeat(old["node"].to_numpy(), n)
            s, f = _floats(old["sim"], np.float32), _floats(old["fresh"], np.uint8)
            if len(new):
                u = np.concatenate((u, _floats(new["u"], np.int64)))
                w = np.concatenate((w, _floats(new["w"], np.int64)))
                s = np.concatenate((s, _floats(new["s"], np.float32)))
                f = np.concatenate((f, np.ones(len(u) - len(f), np.uint8)))
            out = _list_rows(*_best(u, w, s, f, k))
            bare = np.setdiff1d(old["node"].to_numpy(), out["node"].to_numpy())
            if len(bare):
                out = pd.concat([out, pd.DataFrame({"block": (bare >> 32).astype(np.int32), "node": bare, "nbr": b"", "sim": b"", "fresh": b""})])
            return out

        return lists.groupBy("block").cogroup(proposed.groupBy("block")).applyInPandas(merge, LISTS)

    def descend(self, rounds: int = 12, change: float = 0.02) -> "Graph":
        """Rounds of NN-descent until fewer than ``change`` of all list entries are new."""
        for r in range(rounds):
            self.lists = written(self._round(r), "graph")
            fresh = self.lists.select(F.sum(F.length(F.replace(F.hex("fresh"), F.lit("00"), F.lit(""))) / 2), F.sum(F.length("fresh"))).first()
            if not fresh[1] or (fresh[0] or 0) < change * fresh[1]:
                break
        return self

    def _round(self, r: int) -> DataFrame:
        width, k, seed = self.width, self.k, self.seed + 1 + r

        def sampled(part: pd.DataFrame):
            """Edges (v, u, is new) that this round uses: up to SAMPLE fresh and SAMPLE known ones of each node."""
            w, n = _lists(part["nbr"], np.int64)
            v, f = np.repeat(part["node"].to_numpy(), n), _floats(part["fresh"], np.uint8)
            order = np.lexsort((np.random.Generator(np.random.PCG64([seed, int(part["block"].iloc[0])])).random(len(v)), f, v)) if len(v) else np.zeros(0, np.int64)
            key = v[order] * 2 + f[order]
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            rank = np.arange(len(key)) - np.repeat(start, np.diff(np.append(start, len(key))))
            use = np.zeros(len(v), bool)
            use[order[rank < SAMPLE]] = True
            return v, w, f, use

        def ask(part: pd.DataFrame) -> pd.DataFrame:
            v, w, f, use = sampled(part)
            v, w, f = v[use], w[use], f[use]
            return _to_blocks(w >> 32, "block", {"src": w, "dst": v, "new": f})

        def send(key, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            """The vectors of the block to everyone who meets them this round."""
            v, w, f, use = sampled(own)
            src = np.concatenate((v[use], _floats(asked["src"], np.int64)))
            dst = np.concatenate((w[use], _floats(asked["dst"], np.int64)))
            new = np.concatenate((f[use], _floats(asked["new"], np.uint8)))
            # a popular node is asked by many: each meets it, but it meets at most 2 x SAMPLE a kind
            order = np.lexsort((np.random.Generator(np.random.PCG64([seed, 7, int(key[0])])).random(len(dst)), new, dst))
            src, dst, new = src[order], dst[order], new[order]
            sims, n = _lists(own["sim"], np.float32)
            at = np.cumsum(n) - 1
            least = np.where(n >= k, sims[np.maximum(at, 0)] if len(sims) else 0, -np.inf).astype(np.float32)
            row = np.searchsorted(own["node"].to_numpy(), src)
            half = _floats(own["vec"], np.float32, width).astype(np.float16)
            order = np.lexsort((src, dst >> 32))
            src, dst, new, row = src[order], dst[order], new[order], row[order]
            if not len(src):
                return pd.DataFrame({"block": [], "src": [], "vec": [], "least": [], "n": [], "dst": [], "new": []})
            # a vector goes once to each block that wants it; one row holds all that goes there
            head = np.flatnonzero(np.append(True, (src[1:] != src[:-1]) | (dst[1:] >> 32 != dst[:-1] >> 32)))
            to = dst[head] >> 32
            cut = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), len(to))
            edge = np.append(head, len(src))
            n = np.diff(edge).astype(np.int32)
            return pd.DataFrame({"block": to[cut[:-1]].astype(np.int32), "src": _cut(src[head], cut), "vec": _cut(half[row[head]], cut),
                                 "least": _cut(least[row[head]], cut), "n": _cut(n, cut), "dst": _cut(dst, edge[cut]), "new": _cut(new, edge[cut])})

        def meet(part: pd.DataFrame) -> pd.DataFrame:
            """Local joins: whoever was sent to the same node is compared."""
            x = _floats(part["vec"], np.float16, width).astype(np.float32)
            who, least = _floats(part["src"], np.int64), _floats(part["least"], np.float32)
            dst, new = _floats(part["dst"], np.int64), _floats(part["new"], np.uint8)
            row = np.repeat(np.arange(len(who)), _floats(part["n"], np.int32))
            order = np.lexsort((-new.astype(np.int8), dst))
            dst, new, row = dst[order], new[order], row[order]
            bounds = np.append(np.flatnonzero(np.append(True, dst[1:] != dst[:-1])), len(dst)) if len(dst) else np.zeros(1, np.int64)
            us, ws, ss = [], [], []
            for a, b in zip(bounds, bounds[1:], strict=False):
                fresh = a + int(new[a:b].sum())
                fresh, b = min(fresh, a + 4 * SAMPLE), min(b, fresh + 4 * SAMPLE)
                i, j = row[a:fresh], np.concatenate((row[a:fresh], row[a + int(new[a:b].sum()):b]))
                s = x[i] @ x[j].T
                hit = (s > least[i][:, None]) & (who[i][:, None] != who[j])
                p, q = np.nonzero(hit)
                us.append(who[i[p]]), ws.append(who[j[q]]), ss.append(s[p, q])
                hit = (s > least[j]) & (who[i][:, None] != who[j])
                p, q = np.nonzero(hit)
                us.append(who[j[q]]), ws.append(who[i[p]]), ss.append(s[p, q])
            if not us:
                return pd.DataFrame({"block": [], "u": [], "w": [], "s": []})
            u, w, s = np.concatenate(us), np.concatenate(ws), np.concatenate(ss).astype(np.float32)
            u, w, s, _ = _best(u, w, s, np.ones(len(u), np.uint8), k)
            return _to_blocks(u >> 32, "block", {"u": u, "w": w, "s": s})

        def known(part: pd.DataFrame) -> pd.DataFrame:
            """The used fresh edges are known from now on."""
            v, w, f, use = sampled(part)
            f = f & ~(use & (f == 1))
            n = np.array([len(x) for x in part["fresh"]], np.int64)
            return part.assign(fresh=_cut(f.astype(np.uint8), np.append(0, np.cumsum(n))))[["block", "node", "nbr", "sim", "fresh"]]

        lists = self.lists
        ordered = "block int, src binary, dst binary, new binary"
        asked = lists.groupBy("block").applyInPandas(ask, ordered)
        with_vec = lists.join(self.vectors.select("node", "vec"), "node")

        def send_sorted(key, own, got):
            return send(key, own.sort_values("node").reset_index(drop=True), got)

        sent = with_vec.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(
            send_sorted, "block int, src binary, vec binary, least binary, n binary, dst binary, new binary")
        proposed = written(sent.groupBy("block").applyInPandas(meet, PROPOSED), "proposals")
        return self._merged(lists.groupBy("block").applyInPandas(known, LISTS), proposed)

    def adjacency(self) -> DataFrame:
        """``block, node, nbr``: neighbours both ways, the nearest 2 x k at most."""
        k = self.k

        def reverse(part: pd.DataFrame) -> pd.DataFrame:
            w, n = _lists(part["nbr"], np.int64)
            return _to_blocks(w >> 32, "block", {"u": w, "w": np.repeat(part["node"].to_numpy(), n), "s": _floats(part["sim"], np.float32)})

        def join(own: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
            w, n = _lists(own["nbr"], np.int64)
            u, s = np.repeat(own["node"].to_numpy(), n), _floats(own["sim"], np.float32)
            if len(back):
                u, w, s = (np.concatenate(x) for x in ((u, _floats(back["u"], np.int64)), (w, _floats(back["w"], np.int64)), (s, _floats(back["s"], np.float32))))
            return _list_rows(*_best(u, w, s, np.zeros(len(u), np.uint8), 2 * k))[["block", "node", "nbr"]]

        back = self.lists.groupBy("block").applyInPandas(reverse, PROPOSED)
        return written(self.lists.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(
            join, "block int, node long, nbr binary"), "adjacency")

    def search(self, wanted: DataFrame, pool: int = POOL, beam: int = BEAM, step: int = STEP) -> DataFrame:
        """``node, found``: nearest nodes of each node of ``wanted``, by greedy search of the graph."""
        width = self.width
        edges = self.adjacency()
        state = "block int, node long, vec binary, nbr binary, sim binary, fresh binary"
        start = (self.lists.join(wanted.select("node").distinct(), "node", "left_semi").join(self.vectors.select("node", "vec"), "node")
                 .select("block", "node", "vec"))

        def begin(parts):
            for p in parts:
                q = _floats(p["vec"], np.float32, width).copy()
                q[:, -1] = 0.0  # the lift orders the graph; what is searched for is the inner product alone
                own = np.einsum("ij,ij->i", q, q).astype(np.float32)
                yield p.assign(vec=[x.tobytes() for x in q], nbr=[x.tobytes() for x in p["node"].to_numpy()],
                               sim=[x.tobytes() for x in own], fresh=[b"\1"] * len(p))

        now = written(start.mapInPandas(begin, state), "search")

        def next_of(part: pd.DataFrame) -> list[np.ndarray]:
            """For each query, places in its pool (nearest first) that are expanded next."""
            return [np.flatnonzero(np.frombuffer(f, np.uint8)[:beam])[:step] for f in part["fresh"]]

        def asking(query: np.ndarray, vec: np.ndarray, row: np.ndarray, u: np.ndarray) -> pd.DataFrame:
            """One row per block: who (by ``row``) asks it, with which vector, for which of its nodes ``u``."""
            order = np.lexsort((u, row, u >> 32))
            row, u = row[order], u[order]
            if not len(u):
                return pd.DataFrame({"block": [], "query": [], "vec": [], "n": [], "u": []})
            new = np.append(True, (u[1:] != u[:-1]) | (row[1:] != row[:-1]))
            row, u = row[new], u[new]
            block = u >> 32
            head = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (row[1:] != row[:-1])))
            to = block[head]
            cut = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), len(to))
            edge = np.append(head, len(u))
            return pd.DataFrame({"block": to[cut[:-1]].astype(np.int32), "query": _cut(query[row[head]], cut), "vec": _cut(vec[row[head]], cut),
                                 "n": _cut(np.diff(edge).astype(np.int32), cut), "u": _cut(u, edge[cut])})

        def asked_rows(asked: pd.DataFrame):
            for q, vec, n, u in zip(asked["query"], asked["vec"], asked["n"], asked["u"], strict=True):
                q, n = np.frombuffer(q, np.int64), np.frombuffer(n, np.int32)
                yield q, np.frombuffer(vec, np.float32).reshape(-1, width), np.repeat(np.arange(len(q)), n), np.frombuffer(u, np.int64)

        def expand(parts):
            for p in parts:
                at = next_of(p)
                n = np.array([len(x) for x in at], np.int64)
                u = np.concatenate([np.frombuffer(x, np.int64)[i] for x, i in zip(p["nbr"], at, strict=True)]) if len(p) else np.zeros(0, np.int64)
                yield asking(p["node"].to_numpy(), _floats(p["vec"], np.float32, width), np.repeat(np.arange(len(p)), n), u)

        def follow(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            own = own.sort_values("node")
            flat, size = _lists(own["nbr"], np.int64)
            node, start = own["node"].to_numpy(), np.cumsum(size) - size
            out = [asked.iloc[:0]]
            for q, vec, row, u in asked_rows(asked):
                at = np.searchsorted(node, u)
                has = np.append(node, -1)[at] == u  # a node without neighbours has no row
                at, row = at[has], row[has]
                m = size[at]
                place = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(start[at], m)
                out.append(asking(q, vec, np.repeat(row, m), flat[place]))
            return pd.concat(out)

        def score(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            own = own.sort_values("node")
            node, x = own["node"].to_numpy(), _floats(own["vec"], np.float32, width)
            us, ws, ss = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
            for q, vec, row, w in asked_rows(asked):
                for i in range(0, len(w), 65536):
                    part = slice(i, i + 65536)
                    us.append(q[row[part]])
                    ws.append(w[part])
                    ss.append(np.einsum("ij,ij->i", x[np.searchsorted(node, w[part])], vec[row[part]]).astype(np.float32))
            u, w, s, _ = _best(np.concatenate(us), np.concatenate(ws), np.concatenate(ss), np.zeros(sum(map(len, us)), np.uint8), pool)
            return _to_blocks(u >> 32, "block", {"u": u, "w": w, "s": s})

        def merge(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
            fresh = []
            for f, at in zip(old["fresh"], next_of(old), strict=True):
                f = np.frombuffer(f, np.uint8).copy()
                f[at] = 0
                fresh.append(f)
            w, n = _lists(old["nbr"], np.int64)
            u, s = np.repeat(old["node"].to_numpy(), n), _floats(old["sim"], np.float32)
            f = np.concatenate(fresh) if fresh else np.zeros(0, np.uint8)
            if len(new):
                u, w, s = (np.concatenate(x) for x in ((u, _floats(new["u"], np.int64)), (w, _floats(new["w"], np.int64)), (s, _floats(new["s"], np.float32))))
                f = np.concatenate((f, np.ones(len(u) - len(f), np.uint8)))
            got = _list_rows(*_best(u, w, s, f, pool))
            return got.merge(old[["node", "vec"]], on="node")[["block", "node", "vec", "nbr", "sim", "fresh"]]

        asked_schema = "block int, query binary, vec binary, n binary, u binary"
        while True:
            asked = now.mapInPandas(expand, asked_schema)
            asked = asked.groupBy("block").cogroup(edges.groupBy("block")).applyInPandas(follow, asked_schema)
            scored = asked.groupBy("block").cogroup(self.vectors.groupBy("block")).applyInPandas(score, PROPOSED)
            now = written(now.groupBy("block").cogroup(scored.groupBy("block")).applyInPandas(merge, state), "search")
            todo = now.filter(F.substring(F.hex("fresh"), 1, 2 * beam).contains("01")).limit(1).count()
            if not todo:
                break

        def flat(parts):
            for p in parts:
                w, n = _lists(p["nbr"], np.int64)
                yield pd.DataFrame({"node": np.repeat(p["node"].to_numpy(), n), "found": w, "s": _floats(p["sim"], np.float32)})

        return now.mapInPandas(flat, "node long, found long, s float")


def nearest(embeddings: DataFrame, is_query, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of every row that meets ``is_query``."""
    rows = written(clean(embeddings), "vectors")
    graph = Graph(rows, k + 1).descend()
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    first = rows.select(F.col("vec_id").alias("first"), "embedding")
    named = graph.nodes.select("node", F.col("ids")[0].alias("first")).join(first, "first").select("node", "embedding")
    of_query = written(queries.join(named, queries["query"] == named["embedding"]).select("query_id", "node"), "queries")
    found = graph.search(of_query)
    # more nodes than asked for, as the search ranks in single precision
    near = found.withColumn("n", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("s"), "found"))).filter(F.col("n") <= k + 12)
    ids = near.join(graph.nodes.select(F.col("node").alias("found"), "ids"), "found").select("node", F.explode("ids").alias("vec_id"))
    pairs = of_query.join(ids, "node").filter("query_id <> vec_id").select("query_id", "vec_id")
    scored = (pairs.join(queries, "query_id").join(rows, "vec_id")
              .select("query_id", "vec_id", F.aggregate(F.zip_with("query", "embedding", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x).alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
