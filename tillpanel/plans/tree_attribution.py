"""Exact path-dependent attributions of a boosted-tree model, as a Spark SQL job.

A fitted model becomes a table with one row per leaf: for every feature on the
leaf's path the interval (lo, hi] that leads to it, and the share of the training
rows that takes this path where the feature is unknown. The expected value of a
tree, given the features in a set S, is the sum over its leaves of

    value x (1 or 0 for each path feature in S, by the row's value) x (share of each other path feature)

and the attribution of a feature is the Shapley value of this game. For one leaf it
depends on the row only through which intervals hold the row's values: a path of k
features has 2**k such patterns, so the table carries the k contributions for each
pattern. A row is joined to the leaves of every tree (a table bounded by the model,
not by the data), finds its pattern by k comparisons, and its contributions are
summed by (row, feature): no sampling, no background rows, no limit on rows.

Contributions of a row add up to f(x) - base, where base is the expected value with
no feature known.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations
from math import factorial

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.session import scratch_path

LEAF_SCHEMA = ("tree int, value double, feats array<int>, lo array<double>, hi array<double>, "
               "contributions array<array<double>>")


@dataclass
class Leaf:
    """One leaf: its weighted value and, per feature of its path, interval and share."""

    tree: int
    value: float
    feats: list[int] = field(default_factory=list)
    lo: list[float] = field(default_factory=list)
    hi: list[float] = field(default_factory=list)
    share: list[float] = field(default_factory=list)


def tree_nodes(spark: SparkSession, boosted) -> DataFrame:
    """``tree, weight, id, value, cover, left, right, feature, threshold`` of a fitted Spark tree ensemble,
    from the tables in which it is saved."""
    path = scratch_path(spark, "trees")
    boosted.save(path)
    nodes = spark.read.parquet(f"{path}/data")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").select("tree", "weight")
    n = F.col("nodeData")
    return (nodes.join(weights, nodes["treeID"] == F.col("tree"))
            .select(F.col("treeID").alias("tree"), "weight", n["id"].alias("id"), n["prediction"].alias("value"),
                    n["impurityStats"][0].alias("cover"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
                    n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
                    n["split"]["numCategories"].alias("categories")))


def leaf_paths(nodes: DataFrame) -> list[Leaf]:
    """Leaves of all trees; a node table is as large as the model, which the driver holds anyway."""
    trees: dict[int, dict[int, object]] = {}
    for r in nodes.collect():
        if r["left"] >= 0 and r["categories"] != -1:
            raise ValueError("paths are defined for splits by a threshold")
        trees.setdefault(r["tree"], {})[r["id"]] = r
    out = []
    for tree, by_id in sorted(trees.items()):
        open_ = [(by_id[0], {})]
        while open_:
            node, path = open_.pop()
            if node["left"] < 0:
                leaf = Leaf(tree, node["weight"] * node["value"])
                for feature, (lo, hi, share) in sorted(path.items()):
                    leaf.feats.append(feature)
                    leaf.lo.append(lo)
                    leaf.hi.append(hi)
                    leaf.share.append(share)
                out.append(leaf)
                continue
            lo, hi, share = path.get(node["feature"], (float("-inf"), float("inf"), 1.0))
            for child, interval in ((by_id[node["left"]], (lo, min(hi, node["threshold"]))),
                                    (by_id[node["right"]], (max(lo, node["threshold"]), hi))):
                open_.append((child, path | {node["feature"]: (*interval, share * child["cover"] / node["cover"])}))
    return out


def pattern_contributions(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Contributions (leaves, 2**k patterns, k features) of leaves with ``k`` path features each.

    ``share`` is (leaves, k). In pattern p, bit i tells that the row's value lies in feature i's interval.
    """
    k = share.shape[1]
    inside = (np.arange(1 << k)[:, None] >> np.arange(k) & 1).astype(float)
    out = np.zeros((len(share), 1 << k, k))
    for i in range(k):
        others = [j for j in range(k) if j != i]
        for size in range(k):
            weight = factorial(size) * factorial(k - size - 1) / factorial(k)
            for known in combinations(others, size):
                unknown = [j for j in others if j not in known]
                term = np.prod(share[:, unknown], axis=1)[:, None] * np.prod(inside[:, list(known)], axis=1)[None]
                out[:, :, i] += weight * term
        out[:, :, i] *= inside[:, i][None] - share[:, i][:, None]
    return out * value[:, None, None]


def leaf_table(spark: SparkSession, leaves: list[Leaf]) -> DataFrame:
    """Leaves with the contributions of every pattern, one row a leaf."""
    rows = []
    for k in sorted({len(x.feats) for x in leaves}):
        same = [x for x in leaves if len(x.feats) == k]
        if k == 0:
            rows += [(x.tree, x.value, [], [], [], [[]]) for x in same]
            continue
        found = pattern_contributions(np.array([x.share for x in same]), np.array([x.value for x in same]))
        rows += [(x.tree, x.value, x.feats, x.lo, x.hi, c.tolist()) for x, c in zip(same, found, strict=True)]
    return spark.createDataFrame(rows, LEAF_SCHEMA)


def base_value(leaves: list[Leaf]) -> float:
    """Expected value of the ensemble where no feature is known."""
    return float(sum(x.value * np.prod(x.share) for x in leaves))


def _met_leaves(rows: DataFrame, table: DataFrame, n_trees: int, depth: int) -> DataFrame:
    """``rows`` (row_id, x) with every leaf of every tree and the row's pattern there."""
    per_tree = rows.select("row_id", "x", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"))
    met = per_tree.join(F.broadcast(table), "tree")
    pattern = F.lit(0)
    for d in range(depth):
        i = F.lit(d)
        at = F.get("x", F.get("feats", i))
        hit = (at > F.get("lo", i)) & (at <= F.get("hi", i))
        pattern = pattern + F.when(hit, F.lit(1 << d)).otherwise(F.lit(0))
    return met.withColumn("pattern", pattern)


def contributions(rows: DataFrame, boosted) -> tuple[DataFrame, float]:
    """``row_id, input, contribution`` of ``rows`` (row_id, features vector) for every model input that any tree
    uses, and the base value."""
    spark = rows.sparkSession
    leaves = leaf_paths(tree_nodes(spark, boosted))
    depth = max((len(x.feats) for x in leaves), default=0)
    n_trees = max(x.tree for x in leaves) + 1
    vectors = rows.select("row_id", vector_to_array("features").alias("x"))
    met = _met_leaves(vectors, leaf_table(spark, leaves), n_trees, depth)
    each = met.select("row_id", F.explode(F.arrays_zip(F.col("feats").alias("input"), F.get("contributions", F.col("pattern")).alias("c"))).alias("e"))
    summed = each.groupBy("row_id", F.col("e.input").alias("input")).agg(F.sum("e.c").alias("contribution"))
    return summed, base_value(leaves)


def staged_predictions(rows: DataFrame, boosted, lengths: list[int]) -> DataFrame:
    """``row_id, trees, prediction``: what the first ``trees`` trees of the ensemble predict for ``rows``.

    Boosting adds trees one by one, so the first n trees of a run are the run of n trees.
    """
    spark = rows.sparkSession
    leaves = leaf_paths(tree_nodes(spark, boosted))
    depth = max((len(x.feats) for x in leaves), default=0)
    n_trees = max(x.tree for x in leaves) + 1
    vectors = rows.select("row_id", vector_to_array("features").alias("x"))
    met = _met_leaves(vectors, leaf_table(spark, leaves).drop("contributions"), n_trees, depth)
    reached = met.filter(F.col("pattern") == F.pow(F.lit(2), F.size("feats")) - 1)
    sums = reached.groupBy("row_id").agg(*[F.sum(F.when(F.col("tree") < n, F.col("value"))).alias(f"p{n}") for n in lengths])
    each = F.array(*[F.struct(F.lit(n).alias("trees"), F.col(f"p{n}").alias("prediction")) for n in lengths])
    return sums.select("row_id", F.explode(each).alias("e")).select("row_id", "e.trees", "e.prediction")
