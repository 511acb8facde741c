"""Lineage and audit: transitive dependents, blocking dependents, mirrors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stages import discard, stage


def dependents(edges: DataFrame, root: str, max_depth: int | None = None) -> DataFrame:
    """node, depth: everything that depends on root (edges parent -> child), with its greatest depth.

    A frontier is joined to the edges and deduplicated in each round, which keeps parallel paths from multiplying, until it is empty. A cycle raises,
    as do dependents below max_depth, where given."""
    spark = edges.sparkSession
    steps = edges.select(F.col("parent").alias("node"), "child")
    frontier = spark.createDataFrame([(root,)], "node string")
    found = spark.createDataFrame([], "node string, depth int")
    depth = 1
    while True:
        frontier = stage(frontier.join(steps, "node").select(F.col("child").alias("node")).distinct(), "frontier")
        if not frontier.limit(1).count():
            return found.groupBy("node").agg(F.max("depth").alias("depth"))
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"{root} has dependents below depth {max_depth}")
        found = found.unionByName(frontier.withColumn("depth", F.lit(depth)))
        if depth & (depth - 1) == 0:  # now and then: a path longer than the number of nodes it can pass comes to one twice
            found = stage(found.groupBy("node").agg(F.max("depth").alias("depth")), "found")
            if depth > found.count():
                raise ValueError(f"the dependents of {root} form a cycle")
        depth += 1


def trimmed(edges: DataFrame) -> DataFrame:
    """The edges (parent, child) that a cycle can use: nodes that nothing leads to, or that lead nowhere, go with their edges, until none is left."""
    left = stage(edges, "edges")
    while True:
        kept = left.join(left.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi").join(left.select(F.col("parent").alias("child")).distinct(), "child", "left_semi").select("parent", "child")
        kept = stage(kept, "edges")
        before, after = left.count(), kept.count()
        discard(left)
        left = kept
        if before == after:
            return left


def spread_least(values: DataFrame, steps: DataFrame) -> DataFrame:
    """values (node, value) after each node has taken the least value of those that lead to it over steps (parent, child), directly or not."""
    while True:
        came = steps.join(values.withColumnRenamed("node", "parent"), "parent").groupBy(F.col("child").alias("node")).agg(F.min("value").alias("came"))
        new = stage(values.join(came, "node", "left").select("node", F.least("value", "came").alias("value"), (F.col("came") < F.col("value")).alias("moved")), "values")
        if not new.where("moved").limit(1).count():
            return new.drop("moved")
        values = new.drop("moved")


def cycles(edges: DataFrame) -> DataFrame:
    """node, cycle: each node that depends on itself, with the smallest node that it and cycle depend on mutually (text order).

    Strongly connected components by colours: the least node that reaches a node colours it, and of each colour those nodes that reach its least
    one are a component. What is left goes on without edges between colours; each round is joins of edges and settles at least one component a colour."""
    edges = edges.select(F.col("parent").cast("string").alias("parent"), F.col("child").cast("string").alias("child")).where("parent is not null and child is not null").distinct()
    own, rest = edges.where("parent = child").select(F.col("parent").alias("node")), edges.where("parent <> child")
    found = None
    while True:
        rest = trimmed(rest)
        if not rest.limit(1).count():
            break
        nodes = rest.select(F.col("parent").alias("node")).union(rest.select("child")).distinct()
        colours = spread_least(nodes.withColumn("value", F.col("node")), rest).withColumnRenamed("value", "colour")
        inside = rest.join(colours.select(F.col("node").alias("parent"), "colour"), "parent").join(colours.select(F.col("node").alias("child"), F.col("colour").alias("_to")), "child").where("colour = _to").select("parent", "child", "colour")
        inside = stage(inside, "inside")
        # backwards from the least node of each colour: 0 spreads to what reaches it
        marks = spread_least(colours.select("node", (F.col("node") != F.col("colour")).cast("int").alias("value")), inside.select(F.col("child").alias("parent"), F.col("parent").alias("child")))
        part = marks.where("value = 0").select("node").join(colours, "node").select("node", F.col("colour").alias("cycle"))
        met = inside.select(F.col("parent").alias("node")).union(inside.select("child")).distinct()
        part = stage(part.join(met, "node", "left_semi"), "cycles")
        found = part if found is None else found.unionByName(part)
        gone = part.select(F.col("node").alias("parent"))
        rest = inside.select("parent", "child").join(gone, "parent", "left_anti").join(gone.withColumnRenamed("parent", "child"), "child", "left_anti").select("parent", "child")
    alone = own if found is None else own.join(found, "node", "left_anti")
    alone = alone.select("node", F.col("node").alias("cycle"))
    if found is None:
        return alone
    many = found.groupBy("cycle").agg(F.count("*").alias("n")).where("n > 1").select("cycle")
    single = found.join(many, "cycle", "left_anti").join(own, "node", "left_semi")  # a component of one node is a cycle only by an edge to itself
    return found.join(many, "cycle", "left_semi").select("node", "cycle").unionByName(single.select("node", "cycle")).unionByName(alone)


def blocking(found: DataFrame, kinds: DataFrame) -> DataFrame:
    """The dependents that are materialised: replacing what they read would break them."""
    return found.join(kinds.where("kind = 'materialised'").select("node").distinct(), "node", "left_semi")


def refuse_if_blocked(found: DataFrame, kinds: DataFrame) -> None:
    """Raise when a dependent is materialised; the message names the first twenty."""
    blocked = [r["node"] for r in blocking(found, kinds).orderBy("node").limit(20).collect()]
    if blocked:
        raise ValueError(f"materialised dependents: {', '.join(blocked)}")


def missing_objects(objects: DataFrame, mirror: DataFrame) -> DataFrame:
    """Objects without a mirror of that name."""
    return objects.join(mirror, "object_name", "left_anti")


def missing_columns(columns: DataFrame, mirror: DataFrame) -> DataFrame:
    """Columns that the mirror of their object lacks; objects without any mirror are missing_objects' business."""
    return columns.join(mirror.select("object_name").distinct(), "object_name", "left_semi").join(mirror, ["object_name", "column_name"], "left_anti")
