"""Strongly connected components of directed graphs, in rounds of joins.

Nodes with a single edge out form ways that lead to one end each.  Jumps of 1, 2, 4, ... steps along them, one table a
power of two, find the ends and the closed ways in as many rounds as the logarithm of the longest: a closed way is a
component, a way to a node without an edge out holds none, and any other is contracted into its end.  The same is done
against the direction, in turns, until no node has a single edge.  A contracted node belongs to the component of its end if
the way from an edge that comes out of that component passes it, which the tables of jumps tell, last contraction first.

What is left goes by colours: a round trims nodes without an edge in or out, colours each node with the largest node that
reaches it, and walks back from each node that kept its own colour along edges within the colour: what it meets is one
component.  All components that hold the largest node of their colour are found in the same round; they and the edges
between colours go, and the rest takes another round.  Colours and walks move by their frontier alone, every step is
written, and no component, chain or cycle is gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.components import Written


@dataclass
class Contracted:
    """What the way back needs of one contraction."""

    jumps: list[DataFrame]  # (u, to, live, least) after 1, 2, 4, ... steps; live where ``to`` was contracted too
    entries: DataFrame  # (x, y, w): edges x -> y from a node that stayed onto a way that ends in w
    loops: DataFrame  # (w): ends with a way back to themselves


def _contracted(tables: Written, edges: DataFrame, name: str) -> tuple[DataFrame, int, DataFrame | None, Contracted] | None:
    """Edges between nodes of several edges out, their number, the closed ways (node, label), if any, and the way back.

    None where every node has several edges out and no edge ends in a node without.
    """
    out = tables.put(f"{name}-out", edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v")))
    single, several = out.filter("n = 1").select("u", "v"), out.filter("n > 1").select("u")
    size = single.count()
    live = F.col("s").isNotNull()
    of_single = single.select(F.col("u").alias("s"))
    if not size and edges.join(several.select(F.col("u").alias("v")), "v", "left_anti").isEmpty():
        return None
    now = tables.put(f"{name}-0", single.join(of_single, F.col("v") == F.col("s"), "left").select("u", F.col("v").alias("to"), live.alias("live"), F.col("u").alias("least")))
    jumps = [now]
    while not (ended := now.filter("live").isEmpty()) and 1 << (len(jumps) - 1) < size:
        then = now.select(F.col("u").alias("to"), F.col("to").alias("to2"), F.col("live").alias("live2"), F.col("least").alias("least2"))
        went = now.filter("live").join(then, "to").select("u", F.col("to2").alias("to"), F.col("live2").alias("live"), F.least("least", "least2").alias("least"))
        now = tables.put(f"{name}-{len(jumps)}", now.filter("not live").unionByName(went))
        jumps.append(now)
    # After as many steps as there are nodes, whoever still is on a way is on a closed one, and all of it is met.
    closed = now.filter("live").select("to").distinct().join(now.select(F.col("u").alias("to"), "least"), "to").select(F.col("to").alias("node"), F.col("least").alias("label"))
    closed = None if ended else tables.put(f"{name}-closed", closed)
    ends = now.filter("not live").select(F.col("u").alias("y"), F.col("to").alias("w"))
    stay = edges.join(single.select("u"), "u", "left_anti").select(F.col("u").alias("x"), F.col("v").alias("y"))
    direct = stay.join(several.select(F.col("u").alias("y")), "y", "left_semi").select("x", "y", F.col("y").alias("w"), F.lit(False).alias("way"))
    led = stay.join(ends, "y").join(several.select(F.col("u").alias("w")), "w", "left_semi").select("x", "y", "w", F.lit(True).alias("way"))
    kept = tables.put(f"{name}-kept", direct.unionByName(led))
    new = tables.put(f"{name}-edges", kept.filter("x <> w").select(F.col("x").alias("u"), F.col("w").alias("v")).distinct())
    return new, new.count(), closed, Contracted(jumps, kept.filter("way").select("x", "y", "w"), kept.filter("x = w").select("w").distinct())


def _led_back(tables: Written, found: DataFrame, step: Contracted, name: str) -> DataFrame:
    """``found`` (node, label) with the contracted nodes of its components."""
    loops = step.loops.select(F.col("w").alias("node"), F.col("w").alias("label"))
    found = tables.put(f"{name}-ends", found.unionByName(loops.join(found, "node", "left_anti")))
    of = lambda end: found.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))
    met = step.entries.join(of("x"), "x").join(of("w"), "w").filter("lx = lw").select(F.col("y").alias("node"), F.col("lw").alias("label")).distinct()
    met = tables.put("met", met)
    if not met.isEmpty():
        for jump in step.jumps:
            on = met.join(jump.filter("live").select(F.col("u").alias("node"), "to"), "node").select(F.col("to").alias("node"), "label")
            met = tables.put("met", met.unionByName(on).distinct())
    return tables.put(f"{name}-back", found.unionByName(met))


def _trimmed(tables: Written, edges: DataFrame) -> tuple[DataFrame, int]:
    """Edges whose start has an edge in and whose end has one out, until all have."""
    n = edges.count()
    while True:
        kept = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        kept = tables.put("edges", kept.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").select("u", "v"))
        left = kept.count()
        if left in (n, 0):
            return kept, left
        edges, n = kept, left


def _coloured(tables: Written, edges: DataFrame) -> DataFrame:
    """(node, color): the largest node that reaches a node, itself included."""
    nodes = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct()
    color = tables.put("color", nodes.select("node", F.col("node").alias("color")))
    moved = color
    while True:
        told = edges.join(moved.select(F.col("node").alias("u"), "color"), "u").groupBy(F.col("v").alias("node")).agg(F.max("color").alias("told"))
        changed = tables.put("moved", color.join(told, "node").filter("told > color").select("node", F.col("told").alias("color")))
        if changed.isEmpty():
            return color
        new = changed.select("node", F.col("color").alias("new"))
        color = tables.put("color", color.join(new, "node", "left").select("node", F.coalesce("new", "color").alias("color")))
        moved = changed


def _by_colours(tables: Written, now: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(node, label) of the components that one round of colours finds, and the edges that may hold others."""
    color = _coloured(tables, now)
    of = lambda end: color.select(F.col("node").alias(end), F.col("color").alias(f"c{end}"))
    inside = tables.put("inside", now.join(of("u"), "u").join(of("v"), "v").filter("cu = cv").select("u", "v", F.col("cu").alias("color")))
    members = tables.put("members", color.filter("node = color"))
    fresh = members
    while True:
        back = inside.join(fresh.select(F.col("node").alias("v"), "color"), ["v", "color"]).select(F.col("u").alias("node"), "color").distinct()
        fresh = tables.put("fresh", back.join(members, ["node", "color"], "left_anti"))
        if fresh.isEmpty():
            break
        members = tables.put("members", members.unionByName(fresh))
    sizes = tables.put("sizes", members.groupBy("color").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    found = tables.put(f"{name}-found", members.join(sizes, "color").select("node", F.col("color").alias("label")))
    gone = members.select("node")
    rest = inside.join(gone.withColumnRenamed("node", "u"), "u", "left_anti").join(gone.withColumnRenamed("node", "v"), "v", "left_anti")
    return found, tables.put(f"{name}-rest", rest.select("u", "v"))


def strong_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of all nodes that lie on a cycle; component is the smallest node of the strong component.

    An edge from a node to itself is a cycle.  Edges with a null end count for nothing, repeated ones once; any orderable
    type does, and without cycles the result is empty.
    """
    tables = Written(edges.sparkSession)
    every = tables.put("all", edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null").distinct())
    now = every.filter("u <> v")
    left = now.count()
    kind = every.schema["u"].dataType.simpleString()
    found = every.sparkSession.createDataFrame([], f"node {kind}, label {kind}")
    steps: list[tuple[DataFrame | None, Contracted | None]] = []  # components found by the step, and its way back
    stuck = 0
    while left:
        name = f"s{len(steps)}"
        if stuck < 2:  # both directions in turns
            got = _contracted(tables, now, name)
            if got is None:
                stuck += 1
            else:
                now, left, closed, step = got
                steps.append((closed, step))
                stuck = 0
            now = now.select(F.col("v").alias("u"), F.col("u").alias("v"))
            continue
        now, left = _trimmed(tables, now)
        if left:
            some, now = _by_colours(tables, now, name)
            steps.append((some, None))
            left, stuck = now.count(), 0
    for i in range(len(steps) - 1, -1, -1):
        some, step = steps[i]
        if step:
            found = _led_back(tables, found, step, f"b{i}")
        found = found if some is None else found.unionByName(some)
    labelled = tables.put("labelled", found)
    least = tables.put("least", labelled.groupBy("label").agg(F.min("node").alias("component")))
    selves = every.filter("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    out = tables.put("components", labelled.join(least, "label").select("node", "component").unionByName(selves.join(labelled, "node", "left_anti")))
    tables.close("components")
    return out


def cycle_edges(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b, component): the distinct edges that lie on a cycle."""
    comp = strong_components(edges, a, b)
    of = lambda end, name: comp.select(F.col("node").alias(end), F.col("component").alias(name))
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct()
    return pairs.join(of("a", "component"), "a").join(of("b", "other"), "b").filter("component = other").select("a", "b", "component")
