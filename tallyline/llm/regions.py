"""Joining overlapping regions recursively until every linked pair shares a component.

A region holds the nodes that one key brings together; any two nodes that may link share a region. Nothing here lists all
pairs of a region. Each level compares a region's nodes with one pivot only. Nodes within reach of the pivot (its Voronoi
ball) fall into one component and need no further comparison with each other. What is left are nodes of other components:
they move to the next level with their distance to the pivot, and two of them meet only if those distances differ by no more
than the reach (triangle inequality), which is where boundary nodes of the ball are replicated to the outer region. Regions
that hold one component only are finished. Small regions that remain are compared within those windows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm import graph
from tallyline.operators.skew import broadcast_if_small
from tallyline.sources.lake import Scratch

LEAF = 200  # pairs across components for each node, up to which regions are compared directly within their windows
LEVELS = 4


def stars(members: DataFrame, may_link: Callable[..., Column], percent: int, scratch: Scratch) -> DataFrame:
    """``members(region, id, n, place)`` of regions with two nodes or more, with the region's pivot: its smallest (place, n, id).

    A small place means few rare parts ahead of the shared one, so the pivot is the least altered of a group of copies.
    Rows that lie too far back to link even with the smallest node of their region that is not too small go first. One
    shuffle; the windows stream over sorted rows and spill, so a region of any size passes through a task.
    """
    least = F.greatest(F.min("n").over(Window.partitionBy("region")), F.ceil(F.col("n") * percent / 100))
    members = members.withColumn("_least", least).filter(may_link(F.col("n"), F.col("place"), F.col("_least"), F.lit(0)))
    order = Window.partitionBy("region").orderBy("place", "n", "id")
    pivot = F.first(F.struct("id", "n", "place")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return scratch.write(
        members.select("region", "id", "n", "place", pivot.alias("_p"), F.lead("id").over(order).alias("_next"))
               .filter("_p.id <> id OR _next IS NOT NULL")
               .select("region", "id", "n", "place", F.col("_p.id").alias("pivot"), F.col("_p.n").alias("pivot_n"),
                       F.col("_p.place").alias("pivot_place")))


def connect(members: list[DataFrame], compare: Callable[[DataFrame], DataFrame], may_link: Callable[..., Column], percent: int,
            scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(node, component) of linked nodes, and the compared pairs (a, b, distance).

    ``members`` come in one or more tables without common regions, which are shuffled one after another.

    ``compare`` takes pairs ``(a, b)`` and adds their exact distance, or null for pairs that cannot link; a pair links if its
    similarity is at least ``percent`` hundredths.
    ``may_link(n_a, place_a, n_b, place_b)`` is a necessary condition, true in at least one shared region of each linked pair.
    It is false for sizes further apart than ``percent`` allows, or does not look at them.
    """
    reach = 1 - percent / 100
    spark, parts = members[0].sparkSession, []
    for part in members:
        parts.append(stars(part, may_link, percent, scratch))
        graph.release(spark)
    rows = reduce(DataFrame.unionByName, parts)
    done = scratch.write(compare(
        rows.filter("id <> pivot").filter(may_link(*map(F.col, ("pivot_n", "pivot_place", "n", "place"))))
            .select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()))
    within = lambda pairs: pairs.filter(F.col("distance") <= F.lit(reach + 1e-12)).select("a", "b")
    found = scratch.write(graph.components(within(done), scratch))
    rest = _unfinished(rows.filter("id <> pivot"), found, done, scratch)
    graph.release(spark)
    for level in range(1, LEVELS + 1):
        nodes, pairs = _across(rest)
        if not nodes:
            return found, done
        if pairs <= LEAF * nodes or level == LEVELS:
            break
        order = Window.partitionBy("region").orderBy("met", "place", "n", "id")
        first = F.first(F.struct("id", "n", "place", "component", "d")).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        rows = rest.select("region", "id", "n", "place", "component", "d", first.alias("p")).filter("p.id <> id")
        pairs = (rows.filter("p.component <> component").filter(may_link(*map(F.col, ("p.n", "p.place", "n", "place"))))
                     .filter(_window(F.col("d"), F.col("p.d"), reach)))
        fresh = _ordered(pairs, F.col("p.id"), F.col("id")).join(done.select("a", "b"), ["a", "b"], "left_anti")
        done = scratch.write(done.unionByName(compare(fresh)))
        found = scratch.write(graph.components(within(done), scratch))
        rest = _unfinished(rows.select("region", "id", "n", "place", F.col("p.id").alias("pivot")), found, done, scratch)
    one, two = rest.alias("l"), rest.alias("r")
    pairs = (one.join(two, F.col("l.region") == F.col("r.region"))
                .filter("struct(l.n, l.id) < struct(r.n, r.id) AND l.component <> r.component")
                .filter(may_link(*map(F.col, ("l.n", "l.place", "r.n", "r.place"))))
                .filter(_window(F.col("l.d"), F.col("r.d"), reach)))
    fresh = _ordered(pairs, F.col("l.id"), F.col("r.id")).join(done.select("a", "b"), ["a", "b"], "left_anti")
    fresh = scratch.write(fresh)
    graph.release(spark)
    fresh = scratch.write(compare(fresh))
    if within(fresh).isEmpty():
        return found, done.unionByName(fresh)
    done = scratch.write(done.unionByName(fresh))
    return scratch.write(graph.components(within(done), scratch)), done


def _across(rows: DataFrame) -> tuple[int, float]:
    """Nodes in unfinished regions, and their pairs across components."""
    own = rows.groupBy("region", "component").agg(F.count(F.lit(1)).cast("double").alias("n"))
    each = own.groupBy("region").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("s"))
    one = each.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("s")) / 2)).first()
    return int(one[0] or 0), float(one[1] or 0)


def _window(d: Column, e: Column, reach: float) -> Column:
    """Triangle inequality: nodes within reach of each other differ by no more than it in their distance to a pivot."""
    return F.coalesce(F.abs(d - e) <= F.lit(reach + 1e-9), F.lit(True))


def _ordered(pairs: DataFrame, a: Column, b: Column) -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _unfinished(rows: DataFrame, found: DataFrame, done: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes of regions that still hold several components, with their distance to the last pivot where it was taken.

    ``met`` tells that a node is in the pivot's component, so that the next pivot comes from outside it.
    ``rows`` are without the pivots themselves: a pivot has met every node of its region.
    """
    component = broadcast_if_small(found)
    known = (rows.join(component.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
                 .join(component.select(F.col("node").alias("pivot"), F.col("component").alias("_pc")), "pivot", "left")
                 .withColumn("met", F.coalesce(F.col("component") == F.col("_pc"), F.lit(False))))
    held = known.groupBy("region").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"))
    mixed = scratch.write(held.filter("_lo <> _hi").select("region"))
    known = known.join(broadcast_if_small(mixed), "region", "left_semi")
    pairs = done.select(F.least("a", "b").alias("_a"), F.greatest("a", "b").alias("_b"), F.col("distance").alias("d"))
    met = [F.least("id", "pivot") == F.col("_a"), F.greatest("id", "pivot") == F.col("_b")]
    return scratch.write(known.join(pairs, met, "left").select("region", "id", "n", "place", "component", "d", "met"))
