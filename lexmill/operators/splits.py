"""The greedy split of large components in rounds: all seeds whose turn can't depend on another's are split at once.

The serial split takes, again and again, the node of most remaining links (ties: larger name).  A split reaches some
steps around its seed and changes the degrees one step further, so a node that comes first among all within twice that
reach is split just as it would be in its turn, whatever else goes before.  While nodes have at least as many links as a
split takes, a split reaches one step; then what is left hangs together in smaller pieces, and those of bounded size are
split in a task each.  Pieces that are still larger go on in rounds, with the longer reach of sparse graphs.

Degrees only fall, so seeds come in falling order of (degree, name), which numbers the splits afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.components import Written, connected_components
from lexmill.operators.ranges import numbered_in_order

SALTS = 64


def _leaders(tables: Written, live: DataFrame, steps: int, least: int) -> DataFrame:
    """(component, seed, degree): nodes of at least ``least`` links that come first among all within ``steps`` steps."""
    rank = live.groupBy("component", "node").agg(F.count(F.lit(1)).alias("degree")).withColumn("own", F.struct("degree", "node"))
    best = tables.put("best", rank.select("component", "node", "own", F.col("own").alias("top")))
    for _ in range(steps):
        near = live.join(best.select(F.col("node").alias("other"), "top"), "other").groupBy("node").agg(F.max("top").alias("near"))
        best = tables.put("best", best.join(near, "node").select("component", "node", "own", F.greatest("top", "near").alias("top")))
    return best.filter((F.col("own") == F.col("top")) & (F.col("own.degree") >= least)).select("component", F.col("node").alias("seed"), F.col("own.degree").alias("degree"))


def _heaviest(live: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """(seed, term): each seed's ``k`` neighbours of largest weight (ties: smaller name), ranked within salts first."""
    rows = live.join(seeds.select(F.col("seed").alias("node")), "node").select(F.col("node").alias("seed"), "other", "weight")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("other"), F.lit(SALTS)))
    order = (F.desc("weight"), F.col("other"))
    few = rows.withColumn("nth", F.row_number().over(Window.partitionBy("seed", "salt").orderBy(*order))).filter(F.col("nth") <= k)
    return few.withColumn("nth", F.row_number().over(Window.partitionBy("seed").orderBy(*order))).filter(F.col("nth") <= k).select("seed", F.col("other").alias("term"))


def _filled(tables: Written, live: DataFrame, own: DataFrame, most: int) -> DataFrame:
    """(seed, term) with linked nodes in order of name, each of which opens its own links, up to ``most`` a seed."""
    own = tables.put("own", own.withColumn("last", F.lit(None).cast(own.schema["term"].dataType)))
    while True:
        state = own.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.max("last").alias("last")).filter(F.col("n") < most)
        reach = own.select("seed", F.col("term").alias("node")).join(live, "node").select("seed", F.col("other").alias("term"))
        reach = reach.join(own.select("seed", "term"), ["seed", "term"], "left_anti").join(state, "seed")
        fresh = reach.filter(F.col("last").isNull() | (F.col("term") > F.col("last"))).groupBy("seed").agg(F.min("term").alias("term"))
        fresh = tables.put("fresh", fresh.select("seed", "term", F.col("term").alias("last")))
        if fresh.isEmpty():
            return own.select("seed", "term")
        own = tables.put("own", own.unionByName(fresh))


def split_in_rounds(links: DataFrame, most: int, fold: int, fold_one: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """(component, split, term) of components (component, node, other, weight; both directions) by the serial rule.

    ``fold_one`` splits what hangs together by at most ``fold`` links in one task, as (component, degree, seed, term).
    """
    tables = Written(links.sparkSession)
    live = tables.put("live", links)
    kind = links.schema["node"].dataType.simpleString()
    found: list[DataFrame] = []

    def take(seeds: DataFrame, own: DataFrame) -> None:
        """Keep the splits and drop the links of their nodes."""
        nonlocal live
        made = tables.put(f"found{len(found)}", seeds.join(own, "seed").select("component", "degree", "seed", "term"))
        found.append(made)
        gone = made.select(F.col("term").alias("node"))
        live = tables.put("live", live.join(gone, "node", "left_anti").join(gone.withColumnRenamed("node", "other"), "other", "left_anti").select("component", "node", "other", "weight"))

    itself = lambda seeds: seeds.select("seed", F.col("seed").alias("term"))
    while True:
        seeds = tables.put("seeds", _leaders(tables, live, 2, most - 1))
        if seeds.isEmpty():
            break
        take(seeds, itself(seeds).unionByName(_heaviest(live, seeds, most - 1)))
    if not live.isEmpty():
        pieces = tables.put("pieces", connected_components(live, "node", "other").withColumnRenamed("component", "piece"))
        placed = live.join(pieces, "node")
        heavy = tables.put("heavy", placed.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > fold).select("piece"))
        light = placed.join(heavy, "piece", "left_anti")
        made = light.groupBy("piece").applyInPandas(fold_one, f"component {links.schema['component'].dataType.simpleString()}, degree long, seed {kind}, term {kind}")
        found.append(tables.put(f"found{len(found)}", made))
        live = tables.put("live", placed.join(heavy, "piece", "left_semi").select("component", "node", "other", "weight"))
        while not live.isEmpty():
            seeds = tables.put("seeds", _leaders(tables, live, 2 * (most - 1), 1))
            near = live.join(seeds.select(F.col("seed").alias("node")), "node").select(F.col("node").alias("seed"), F.col("other").alias("term"))
            take(seeds, _filled(tables, live, itself(seeds).unionByName(near), most))
    if not found:
        return links.select("component", F.lit(0).alias("split"), F.col("node").alias("term")).limit(0)
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    seeds = rows.groupBy("component", "degree", "seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("component", "seed", "degree")
    ranked = numbered_in_order(seeds, ["component", F.desc("degree"), F.desc("seed")])
    first = ranked.groupBy("component").agg(F.min("number").alias("first"))
    numbers = ranked.join(first, "component").select("seed", (F.col("number") - F.col("first")).cast("int").alias("split"))
    tables.close(*(f"found{i}" for i in range(len(found))))
    return rows.join(numbers, "seed").select("component", "split", "term")
