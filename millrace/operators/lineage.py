"""Transitive inputs and dependency levels of assets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import checkpoint


def upstream(edges: DataFrame, max_depth: int | None = None, start: DataFrame | None = None) -> DataFrame:
    """All inputs an asset depends on directly or not, with the least depth.

    Known paths are doubled: an input at a depth between n and 2n lies behind one at n, so
    pairs at exactly n, joined with all pairs up to n, give the next ones. A depth of n
    takes about log2(n) rounds, and a cycle ends by itself because only the least depth of a
    pair is kept. With ``start(asset)`` only the inputs of these assets are made, by following
    edges from there, a round for each depth. Rounds are checkpointed; only the test whether
    anything is left comes back to the driver. If ``max_depth`` is given, a closure that is
    deeper is an error, not a shorter answer.
    """
    step = checkpoint(edges.select(F.col("consumer").alias("asset"), F.col("dep").alias("upstream"))
                      .distinct().withColumn("depth", F.lit(1)))
    if start is not None:
        return _upstream_of(step, start.select("asset").distinct(), max_depth)
    known, depth = step, 1
    while True:
        _check_depth(known, max_depth)
        ends = known.filter(F.col("depth") == depth)
        if ends.isEmpty():
            return known
        further = known.select(F.col("asset").alias("upstream"), F.col("upstream").alias("beyond"), F.col("depth").alias("more"))
        reached = ends.join(further, "upstream").select("asset", F.col("beyond").alias("upstream"), (F.col("depth") + F.col("more")).alias("depth"))
        known = checkpoint(known.unionByName(reached).groupBy("asset", "upstream").agg(F.min("depth").alias("depth")))
        depth *= 2


def _upstream_of(step: DataFrame, start: DataFrame, max_depth: int | None) -> DataFrame:
    edges = step.select(F.col("asset").alias("upstream"), F.col("upstream").alias("beyond"))
    known, depth = checkpoint(step.join(start, "asset", "left_semi")), 1
    while True:
        _check_depth(known, max_depth)
        ends = known.filter(F.col("depth") == depth)
        if ends.isEmpty():
            return known
        depth += 1
        reached = ends.join(edges, "upstream").select("asset", F.col("beyond").alias("upstream"), F.lit(depth).alias("depth"))
        known = checkpoint(known.unionByName(reached).groupBy("asset", "upstream").agg(F.min("depth").alias("depth")))


def _check_depth(known: DataFrame, max_depth: int | None) -> None:
    if max_depth is not None and not known.filter(F.col("depth") > max_depth).isEmpty():
        raise ValueError(f"lineage is deeper than {max_depth} levels")


def topo_levels(edges: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Level of every asset: 0 without inputs, else one more than its deepest input.

    With ``assets(uri)`` given, an edge to anything else is an unknown dependency. Assets
    that cannot be ordered are kept with a null level and a reason: ``cycle`` for members
    of one, ``unknown dependency`` for others with such an input or behind one that has,
    ``behind a cycle`` for the rest.

    One table holds how many inputs of each asset are not settled yet. A round settles
    those with none and lowers the number of what depends on them. The number of rounds is
    the depth of the graph.
    """
    step = edges.select("consumer", "dep").distinct()
    if assets is None:
        nodes = step.select(F.col("consumer").alias("uri")).union(step.select("dep")).distinct()
    else:
        nodes = assets.select("uri").distinct()
    nodes, step = checkpoint(nodes), checkpoint(step)
    unknown = step.join(nodes.select(F.col("uri").alias("dep")), "dep", "left_anti")
    unknown = checkpoint(unknown.select(F.col("consumer").alias("uri")).distinct())
    # an unknown input is never settled
    settled, waiting = _settle(nodes, step)
    ordered = [s.select("uri", F.lit(level).alias("level"), F.lit(None).cast("string").alias("rejected"))
               for level, s in enumerate(settled)]
    if waiting.isEmpty():
        return reduce(DataFrame.unionByName, ordered, nodes.limit(0).select("uri", F.lit(0).alias("level"), F.lit("").alias("rejected")))
    left = checkpoint(step.join(waiting.select(F.col("uri").alias("consumer")), "consumer", "left_semi"))
    of = lambda found, reason: found.select("uri", F.lit(reason).alias("rejected"))
    reasons = [of(_cycle_members(waiting, left), "cycle"),
               of(_reachable(left, unknown.join(waiting, "uri", "left_semi")), "unknown dependency"),
               of(waiting, "behind a cycle")]
    # the first reason that holds
    first = reduce(DataFrame.unionByName, [r.withColumn("_nth", F.lit(i)) for i, r in enumerate(reasons)])
    rejected = first.groupBy("uri").agg(F.min(F.struct("_nth", "rejected")).alias("r")).select(
        "uri", F.lit(None).cast("int").alias("level"), "r.rejected")
    return reduce(DataFrame.unionByName, [*ordered, rejected])


def _settle(nodes: DataFrame, edges: DataFrame, consumer: str = "consumer", dep: str = "dep") -> tuple[list[DataFrame], DataFrame]:
    """Nodes without open inputs, level by level, and those that always keep one."""
    counts = edges.groupBy(F.col(consumer).alias("uri")).agg(F.count(F.lit(1)).alias("open"))
    waiting = checkpoint(nodes.select("uri").join(counts, "uri", "left").withColumn("open", F.coalesce("open", F.lit(0))))
    settled = []
    while True:
        ready = waiting.filter("open = 0").select("uri")
        if ready.isEmpty():
            return settled, waiting.select("uri")
        settled.append(ready)
        done = edges.join(ready.select(F.col("uri").alias(dep)), dep).groupBy(F.col(consumer).alias("uri")).agg(
            F.count(F.lit(1)).alias("done"))
        waiting = checkpoint(waiting.filter("open > 0").join(done, "uri", "left").select(
            "uri", (F.col("open") - F.coalesce("done", F.lit(0))).alias("open")))


def _cycle_members(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that depend on themselves, directly or not, by colouring forward and collecting backward.

    Nodes that nothing in question depends on go first, again and again; then each node lies
    on a cycle or between two. All take the largest name among those they depend on. A
    node that keeps its own name as colour depends on itself through nodes of that colour
    alone, or stands on no cycle; what it depends on within its colour is its component. The
    components found are taken out, and the rest is coloured anew.
    """
    found, core = [], nodes
    while True:
        inner = _inside(edges, core)
        _, core = _settle(core, inner, "dep", "consumer")
        if core.isEmpty():
            break
        inner = checkpoint(_inside(edges, core))
        colour = checkpoint(core.select("uri", F.col("uri").alias("colour")))
        while True:
            seen = inner.join(colour.select(F.col("uri").alias("dep"), "colour"), "dep").select(F.col("consumer").alias("uri"), "colour")
            after = checkpoint(colour.unionByName(seen).groupBy("uri").agg(F.max("colour").alias("colour")))
            changed = after.exceptAll(colour)
            colour = after
            if changed.isEmpty():
                break
        # edges within one colour, followed from each root to what it depends on
        same = inner.join(colour.select(F.col("uri").alias("consumer"), "colour"), "consumer").join(
            colour.select(F.col("uri").alias("dep"), F.col("colour").alias("_other")), "dep").filter("colour = _other")
        same = checkpoint(same.select("consumer", "dep"))
        roots = colour.filter("uri = colour").select("uri")
        # a root on no cycle has no edge within its colour
        roots_on_cycles = roots.join(same.select(F.col("consumer").alias("uri")).distinct(), "uri", "left_semi")
        members = checkpoint(_reachable(same.select(F.col("dep").alias("consumer"), F.col("consumer").alias("dep")), roots_on_cycles))
        found.append(members)
        core = checkpoint(core.join(members.union(roots), "uri", "left_anti"))
    return reduce(DataFrame.unionByName, found, nodes.limit(0))


def _inside(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return edges.join(nodes.select(F.col("uri").alias("consumer")), "consumer", "left_semi").join(
        nodes.select(F.col("uri").alias("dep")), "dep", "left_semi")


def _reachable(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Assets at or behind the sources."""
    found, frontier = [sources], sources
    while not frontier.isEmpty():
        known = reduce(DataFrame.unionByName, found)
        frontier = checkpoint(
            edges.join(frontier.select(F.col("uri").alias("dep")), "dep", "left_semi")
            .select(F.col("consumer").alias("uri")).distinct()
            .join(known, "uri", "left_anti"))
        found.append(frontier)
    return reduce(DataFrame.unionByName, found)
