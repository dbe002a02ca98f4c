"""Co-occurrence graphs, degrees, clusters and graph rules."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators import splits
from lexmill.operators.components import connected_components, cut
from lexmill.operators.ranges import numbered_in_order


def cooccurrence(mentions: DataFrame, least_weight: int = 1, block: int = 1000) -> DataFrame:
    """[GR-10] (a, b, weight) with a < b: documents that hold both items of (doc, item).

    The items of a document meet in one array.  Those of a document of more than ``block`` different items are dealt into
    blocks of about that size, and each pair of blocks is a row of its own, so that its pairs are made by many tasks.
    """
    rows = mentions.select("doc", "item").filter("doc is not null and item is not null").distinct()
    sizes = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)  # one in ``block`` rows at most
    rows = rows.join(sizes, "doc", "left").withColumn("blocks", F.ceil(F.coalesce("n", F.lit(1)) / block).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    sets = rows.groupBy("doc", "blocks", "block").agg(F.collect_list("item").alias("s"))
    firsts = sets.select(F.array_sort("s").alias("s")).select("s", F.posexplode("s").alias("i", "a"))
    inside = firsts.select("a", F.explode(F.slice("s", F.col("i") + 2, F.size("s"))).alias("b"))
    large = sets.filter("blocks > 1")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    left = large.select("doc", F.col("block").alias("lo"), F.col("s").alias("x"), other).withColumnRenamed("other", "hi").filter("lo < hi")
    right = large.select("doc", F.col("block").alias("hi"), F.col("s").alias("y"), other).withColumnRenamed("other", "lo").filter("lo < hi")
    across = left.join(right, ["doc", "lo", "hi"]).select(F.explode("x").alias("x"), "y").select("x", F.explode("y").alias("y"))
    pairs = inside.unionByName(across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("weight")).filter(F.col("weight") >= least_weight)


def both_ways(edges: DataFrame) -> DataFrame:
    """[GR-01] (node, other, weight); parallel edges keep the largest weight."""
    rows = edges.select(F.col("a").alias("node"), F.col("b").alias("other"), "weight").unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"), "weight"))
    return rows.groupBy("node", "other").agg(F.max("weight").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """[AG-13]"""
    return both_ways(edges).groupBy("node").agg(F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("weight_sum"), F.max("weight").alias("weight_max"))


def over_generic(edges: DataFrame, ratio: float = 0.70) -> DataFrame:
    """[L5-001, PD-13]"""
    d = degrees(edges)
    n = d.agg(F.count(F.lit(1)).alias("nodes"))
    return d.crossJoin(F.broadcast(n)).withColumn("ratio", F.try_divide(F.col("degree"), F.col("nodes") - 1)).filter(F.col("ratio") > ratio).select("node", "degree", "ratio")  # one row


def phantoms(edges: DataFrame, ratio: float = 0.90) -> DataFrame:
    """[L5-002, PD-14]"""
    share = F.col("weight_max") / F.col("weight_sum")
    return degrees(edges).filter((F.col("degree") == 1) & (share >= ratio)).select("node", "weight_sum", share.alias("ratio"))


def majority(rows: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """[AG-12] The most frequent value of each group; ties go to the value met first by ``order``."""
    counted = rows.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    best = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), "first", value))
    return counted.withColumn("nth", best).filter("nth = 1").select(group, F.col(value).alias("majority"), "n")


def disagreements(members: DataFrame, levels: DataFrame) -> DataFrame:
    """[L5-003, JN-19, GR-06] Members (cluster, term) whose level differs from the majority of their cluster."""
    rows = members.join(levels, "term")
    return rows.join(majority(rows, "cluster", "level", "term"), "cluster").filter(F.col("level") != F.col("majority")).select("cluster", "term", "level", "majority")


def numbered(components: DataFrame, prefix: str) -> DataFrame:
    """[WN-04, GR-02] Nodes with a component id numbered in order of the smallest node.

    The ids are ranks over ranges of the smallest nodes, so that names with one common beginning are ranked by many tasks.
    """
    names = numbered_in_order(components.select("component").distinct(), ["component"])
    ids = names.select("component", F.format_string(f"{prefix}-%04d", F.col("number").cast("long")).alias("id"))
    return components.join(ids, "component").select("node", "id")


def neighbours(edges: DataFrame, k: int = 10) -> DataFrame:
    """[ST-09] (node, rank, other, weight): the ``k`` neighbours of a node, heaviest first, ties by name."""
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("weight"), "other"))
    return both_ways(edges).withColumn("rank", rank).filter(F.col("rank") <= k).select("node", "rank", "other", "weight")


def graph_findings(edges: DataFrame, members: DataFrame, levels: DataFrame, generic: float = 0.70, phantom: float = 0.90) -> DataFrame:
    """[GR-07, L5-001..L5-003] (rule_id, blocking, term) of the three graph checks."""
    row = lambda df, rule, blocking, node: df.select(F.lit(rule).alias("rule_id"), F.lit(blocking).alias("blocking"), F.col(node).alias("term"))
    out = row(over_generic(edges, generic), "L5-001", True, "node").unionByName(row(phantoms(edges, phantom), "L5-002", False, "node"))
    return out.unionByName(row(disagreements(members, levels), "L5-003", False, "term"))


def hub_flags(edges: DataFrame, suspects: DataFrame) -> DataFrame:
    """[JN-21] Edges with whether either end is on the list of suspects (name), compared without regard to case."""
    known = suspects.select(F.lower(F.trim("name")).alias("k")).distinct()
    at = lambda c, flag: known.select(F.col("k").alias(c), F.lit(True).alias(flag))
    rows = edges.withColumn("ka", F.lower(F.trim("a"))).withColumn("kb", F.lower(F.trim("b")))
    rows = rows.join(at("ka", "hub_a"), "ka", "left").join(at("kb", "hub_b"), "kb", "left")
    return rows.select("a", "b", "weight", (F.coalesce("hub_a", F.lit(False)) | F.coalesce("hub_b", F.lit(False))).alias("suspect"))


FOLD_LINKS = 50_000


def clusters(edges: DataFrame, most: int = 10, fold: int = FOLD_LINKS) -> DataFrame:
    """[GR-03..GR-05, AG-14] (component, split, term): components of 2 to ``most`` nodes whole, larger ones split greedily.

    A split starts at the node of most remaining links (ties: larger name), takes its neighbours by falling score, then
    linked nodes in order of name; what is left alone goes.  Splits are numbered in the order of their seeds.  Components
    of up to ``fold`` links are split in a task each, larger ones in rounds of joins over all of them (``splits``), with
    the same result.
    """
    comp = connected_components(edges)
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sized = comp.join(sizes, "component")
    small = sized.filter(F.col("size").between(2, most)).select("component", F.lit(0).alias("split"), F.col("node").alias("term"))
    big = sized.filter(F.col("size") > most).select("node", "component")
    links, _ = cut(both_ways(edges).filter("node <> other").join(big, "node").select("component", "node", "other", "weight"), "links")
    heavy = links.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > fold).select("component")
    kind = comp.schema["node"].dataType.simpleString()
    light = links.join(heavy, "component", "left_anti")

    def numbered_splits(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(c, n, t) for n, (c, _, _, own) in enumerate(_fold(pdf, most)) for t in own]
        return pd.DataFrame(rows, columns=["component", "split", "term"])

    def seeded(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(c, degree, seed, t) for c, degree, seed, own in _fold(pdf, most) for t in own]
        return pd.DataFrame(rows, columns=["component", "degree", "seed", "term"])

    out = small.unionByName(light.groupBy("component").applyInPandas(numbered_splits, f"component {kind}, split int, term {kind}"))
    if heavy.isEmpty():
        return out
    return out.unionByName(splits.split_in_rounds(links.join(heavy, "component").select("component", "node", "other", "weight"), most, fold, seeded))


def _fold(pdf: pd.DataFrame, most: int) -> list[tuple]:
    """(component, degree of the seed, seed, terms) of the splits of one piece of bounded size, in order; none of one term."""
    near: dict = {}
    for node, other, weight in sorted(zip(pdf["node"], pdf["other"], pdf["weight"]), key=lambda x: (x[0], -x[2], x[1])):
        near.setdefault(node, []).append(other)
    linked = {k: set(v) for k, v in near.items()}
    left, out = set(near), []
    while left:
        seed = max(left, key=lambda t: (len(linked[t] & left), t))
        degree = len(linked[seed] & left)
        own = [seed, *[o for o in near[seed] if o in left and o != seed][: most - 1]]
        for t in sorted(left.difference(own)):
            if len(own) >= most:
                break
            if any(t in linked[o] for o in own):
                own.append(t)
        left.difference_update(own)
        if len(own) > 1:
            out.append((pdf["component"].iloc[0], degree, seed, own))
    return out


BUCKETS = ((1, 1), (2, 4), (5, 9), (10, 19), (20, 49), (50, 99), (100, None))
THRESHOLDS = (1, 2, 5, 10, 20, 50, 100)


def weight_distribution(edges: DataFrame) -> DataFrame:
    """[AG-19] (bucket, n, pct)."""
    label = F.when(F.lit(False), "")
    for lo, hi in BUCKETS:
        name = f"{lo}+" if hi is None else str(lo) if lo == hi else f"{lo}-{hi}"
        label = label.when((F.col("weight") >= lo) & (F.col("weight") <= hi if hi else F.lit(True)), name)
    n = edges.agg(F.count(F.lit(1)).alias("all"))
    return edges.groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(n)).select("bucket", "n", F.round(100.0 * F.col("n") / F.col("all"), 4).alias("pct"))  # one row


def threshold_breakdown(edges: DataFrame) -> DataFrame:
    """[AG-19, AG-20] (min_weight, edges, edges_pct, nodes, nodes_pct) at each threshold, in two aggregates."""
    levels = F.explode(F.filter(F.array(*map(F.lit, THRESHOLDS)), lambda t: F.col("weight") >= t)).alias("min_weight")
    by_edge = edges.select(levels).groupBy("min_weight").agg(F.count(F.lit(1)).alias("edges"))
    top = degrees(edges).select(F.col("weight_max").alias("weight"))
    by_node = top.select(levels).groupBy("min_weight").agg(F.count(F.lit(1)).alias("nodes"))
    total = edges.agg(F.count(F.lit(1)).alias("e")).crossJoin(top.agg(F.count(F.lit(1)).alias("v")))
    rows = by_edge.join(by_node, "min_weight").crossJoin(F.broadcast(total))  # one row
    pct = lambda a, b: F.round(100.0 * F.col(a) / F.col(b), 4)
    return rows.select("min_weight", "edges", pct("edges", "e").alias("edges_pct"), "nodes", pct("nodes", "v").alias("nodes_pct"))


def top_hubs(edges: DataFrame, k: int = 20) -> DataFrame:
    """[ST-08]"""
    return degrees(edges).orderBy(F.desc("degree"), F.desc("weight_sum"), "node").limit(k)
