"""Parent-child rows resolved to trees of unknown depth.

Leaves are peeled bottom-up: a node that no remaining node points to leaves the graph and sends its
subtree size to its parent; afterwards, in reverse peel order, every peeled node takes root, depth and
path from its parent. Peeling alone needs as many rounds, each a Spark job, as the deepest tree has
levels. So after ``peel_rounds`` rounds, which clear the many shallow trees and the lower levels of the
others, the rest is resolved by pointer doubling in log2(depth) rounds; what no round can finish leads
into a cycle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.lookup import HOT_LEAST, hot_keys, lookup_join
from tarnlake.operators.packing import running_sum
from tarnlake.session import Staged, stage

#: Spellings of "no parent", besides null, blank and zeros.
NO_PARENT = ("none", "null", "nil", "nan", "n/a", "na", "zero", "root", "-", "--", "\\n", "undefined")


def clean_id(c):
    """An id without case and surrounding white space; blank is null."""
    t = F.lower(F.regexp_replace(c.cast("string"), r"^[\s\x{00a0}\x{3000}]+|[\s\x{00a0}\x{3000}]+$", ""))
    return F.when(t != "", t)


def clean_parent(c):
    """A parent id as ``clean_id``; any spelling of none or zero is null."""
    t = clean_id(c)
    return F.when(~t.isin(*NO_PARENT) & ~t.rlike(r"^(0x)?0+(\.0+)?$"), t)


def tree_nodes(df: DataFrame, node: str, parent: str, order: str | None = None, payload: str | None = None) -> DataFrame:
    """One row ``(id, parent, payload)`` per node id.

    Repeated rows of an id: the latest by ``order`` counts, ties go to the larger parent id (a parent
    before none), so the choice doesn't depend on row order. Rows without an id are left out.
    """
    key = F.struct(F.col(order) if order else F.lit(0), F.coalesce(F.col("parent"), F.lit("")))
    return (
        df.select(clean_id(F.col(node)).alias("id"), clean_parent(F.col(parent)).alias("parent"), (F.col(payload) if payload else F.lit(None).cast("string")).alias("payload"), *([F.col(order)] if order and order not in (node, parent, payload) else []))
        .where("id is not null")
        .groupBy("id")
        .agg(F.max_by(F.struct("parent", "payload"), key).alias("r"))
        .select("id", "r.parent", "r.payload")
    )


@dataclass(frozen=True)
class Ride:
    """What rides along every way up: ``own`` of a node, from its columns payload and id, and an associative ``join`` of
    what the nodes above a place hold with what those below it hold."""

    own: Callable[[], Column]
    join: Callable[[Column, Column], Column]


#: The ids, or payloads, from the root down.
PATH = Ride(lambda: F.array(F.coalesce("payload", "id")), lambda up, low: F.concat(up, low))


def resolve_trees(nodes: DataFrame, peel_rounds: int = 3, with_sizes: bool = False, with_paths: bool = False, ride: Ride | None = None) -> DataFrame:
    """``(id, root, depth, state, n_children[, subtree][, path | payload, ride])`` for ``nodes (id, parent, payload)``, unique by id.

    - state ``whole``: the way up ends at a node without parent; ``lost``: it ends at a node whose parent
      has no row; ``cycle``: the node lies on a loop (a node that is its own parent included);
      ``below_cycle``: the way up runs into a loop. root: the last node of the way up, or the smallest id
      on the loop; depth: steps to it, or to the first node of the loop (0 on it).
    - subtree: number of descendants, the node itself included; null on and below loops where it isn't defined.
    - path: ``payload`` (or the id, where payload is null) of each node from the root down to this one;
      on loops only the node itself, below loops from the first node after the loop. ``ride``: the same for any fold.
    - an empty input gives an empty result.
    """
    fold = PATH if with_paths else ride
    more = ["payload", "ride"] if fold else []
    held = Staged(nodes, "nodes", rows=F.lit(True))
    nodes, total = held.df, held.counts["rows"]
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("up")).agg(F.count("*").alias("n"))
    hot: list = []
    if total > HOT_LEAST:
        kids = stage(kids, "kids")
        hot = hot_keys(kids, "up", "n", total)
    # one join of unique keys tells both who has children and which parents have no row; hot parents cost nothing in it
    known = stage(nodes.join(kids, F.col("id") == F.col("up"), "full").select("id", "parent", "payload", F.coalesce("n", F.lit(0)).alias("n_children"), "up"), "known")
    gone = known.where("id is null").select(F.col("up").alias("gone"), F.lit(True).alias("lost"))
    hot_gone = [r[0] for r in gone.where(F.col("gone").isin(hot)).select("gone").collect()] if hot else []
    base = lookup_join(known.where("id is not null").drop("up"), gone, F.col("parent") == F.col("gone"), "parent", "gone", hot_gone).select(
        "id", "payload", "n_children", F.when(F.col("lost").isNull(), F.col("parent")).alias("parent"), F.when(F.col("lost"), F.lit("lost")).otherwise(F.lit("whole")).alias("top"),
        F.col("n_children").alias("open_children"), F.lit(1).cast("long").alias("size"),
    )
    layers = [Staged(base, "peel0")]
    for r in range(peel_rounds):
        # a layer's leaves leave the graph and send their number and sizes to their parents
        leaves, inner = layers[-1].df.where("open_children = 0"), layers[-1].df.where("open_children > 0")
        sent = leaves.where("parent is not null").groupBy(F.col("parent").alias("up")).agg(F.count("*").alias("n_sent"), F.sum("size").alias("sent"))
        rest = inner.join(sent, F.col("id") == F.col("up"), "left").withColumn("open_children", F.col("open_children") - F.coalesce("n_sent", F.lit(0))).withColumn("size", F.col("size") + F.coalesce("sent", F.lit(0)))
        layers.append(Staged(rest.drop("up", "n_sent", "sent"), f"peel{r + 1}"))
    done = _double(layers[-1].df, with_sizes, fold)
    for r, layer in enumerate(reversed(layers[:-1])):
        leaves = layer.df.where("open_children = 0")
        above = done.select(F.col("id").alias("up"), F.col("root").alias("up_root"), F.col("depth").alias("up_depth"), F.col("state").alias("up_state"), *([F.col("ride").alias("up_ride")] if fold else []))
        got = lookup_join(leaves.where("parent is not null"), above, F.col("parent") == F.col("up"), "parent", "up", hot)
        on_loop = F.col("up_state").isin("cycle", "below_cycle")
        got = got.select(
            "id", F.col("up_root").alias("root"), (F.col("up_depth") + 1).alias("depth"), F.when(on_loop, F.lit("below_cycle")).otherwise(F.col("up_state")).alias("state"), "n_children", F.when(~on_loop, F.col("size")).alias("subtree"),
            *(["payload", F.when(F.col("up_state") == "cycle", fold.own()).otherwise(fold.join(F.col("up_ride"), fold.own())).alias("ride")] if fold else []),
        )
        tops = leaves.where("parent is null").select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("depth"), F.col("top").alias("state"), "n_children", F.col("size").alias("subtree"), *(["payload", fold.own().alias("ride")] if fold else []))
        new = got.unionByName(tops)
        # the last leaves, the bulk of most trees, are nobody's parents: they needn't be written
        done = done.unionByName(stage(new, f"resolved{r}") if r + 1 < len(layers) - 1 else new)
    done = done.select("id", "root", "depth", "state", "n_children", *(["subtree"] if with_sizes else []), *more)
    return done.drop("payload").withColumnRenamed("ride", "path") if with_paths else done


def _double(core: DataFrame, with_sizes: bool, fold: Ride | None) -> DataFrame:
    """What peeling left, by pointer doubling: in round k each open node knows its ancestor 2**k steps up.

    ``size`` holds the descendants nearer than 2**k steps and those peeled below them, so adding the sizes
    of the open nodes 2**k steps below doubles the reach. A round in which no node reaches the top proves
    that all open nodes lead into loops, since a longer way up has nodes of every smaller depth on it.
    """
    more = ["payload", "ride"] if fold else []
    state = Staged(core.select("id", "n_children", "size", F.coalesce("parent", "id").alias("p"), F.when(F.col("parent").isNotNull(), 1).otherwise(0).cast("long").alias("d"), F.col("parent").isNotNull().alias("open"), F.when(F.col("parent").isNull(), F.col("top")).alias("state"), F.least("id", "parent").alias("low"), *(["payload", fold.own().alias("ride")] if fold else [])), "ptr", open=F.col("open"))
    n_open, k, stuck = state.counts["open"], 0, None
    while n_open:
        is_open = state.df.where("open")
        up = state.df.select(F.col("id").alias("q"), F.col("p").alias("q_p"), F.col("d").alias("q_d"), F.col("open").alias("q_open"), F.col("state").alias("q_state"), F.col("low").alias("q_low"), *([F.col("ride").alias("q_ride")] if fold else []))
        moved = lookup_join(is_open, up, F.col("p") == F.col("q"), "p", "q", _hot(is_open, "p", n_open)).select(
            "id", "n_children", "size", F.col("q_p").alias("p"), (F.col("d") + F.col("q_d")).alias("d"), F.col("q_open").alias("open"), F.col("q_state").alias("state"), F.least("low", "q_low").alias("low"), *(["payload", fold.join(F.col("q_ride"), F.col("ride")).alias("ride")] if fold else [])
        )
        new = state.df.where("not open").unionByName(moved)
        if with_sizes:
            sent = is_open.groupBy(F.col("p").alias("q")).agg(F.sum("size").alias("sent"))
            new = new.join(sent, F.col("id") == F.col("q"), "left").withColumn("size", F.col("size") + F.coalesce("sent", F.lit(0))).drop("q", "sent")
        fresh = Staged(new, f"ptr{k}", open=F.col("open"))
        left_open = fresh.counts["open"]
        if left_open == n_open:  # loops only: this round's sizes and rides went round them, its pointers serve
            stuck = fresh.df.where("open").select("id", "p", "low")
            break
        state.drop()
        state, n_open, k = fresh, left_open, k + 1
    closed = state.df.where("not open").select("id", F.col("p").alias("root"), F.col("d").alias("depth"), "state", "n_children", F.col("size").alias("subtree"), *more)
    if not n_open:
        return closed
    return closed.unionByName(_loops(core, stuck, n_open, fold))


def _hot(df: DataFrame, key: str, n: int) -> list:
    """Hot keys of ``df``, of ``n`` rows; where there are fewer than a hot key must have, none needs to be looked for."""
    return hot_keys(df.groupBy(key).agg(F.count("*").alias("_n")), key, "_n", n) if n > HOT_LEAST else []


def _loops(core: DataFrame, far: DataFrame, n: int, fold: Ride | None) -> DataFrame:
    """The ``n`` nodes of ``far``, all on loops or below them: each with the node p some 2**k steps up and the smallest id
    on the way there, both included.

    The nodes that others reach by 2**k steps get fewer with k until only those on loops are left; as soon as twice the
    steps reach as many, no step reaches fewer. A loop's smallest id is found when neighbours agree on it.
    """
    stuck = stage(core.join(far.select(F.col("id").alias("stuck"), "p", "low"), F.col("id") == F.col("stuck")).select("id", "parent", "n_children", "payload", "p", "low"), "stuck")
    jump, reached = stuck.select("id", "p", "low"), -1
    while (now := jump.select("p").distinct().count()) != reached:
        to = jump.select(F.col("id").alias("q"), F.col("p").alias("q_p"), F.col("low").alias("q_low"))
        jump = stage(lookup_join(jump, to, F.col("p") == F.col("q"), "p", "q", _hot(jump, "p", n), "inner").select("id", F.col("q_p").alias("p"), F.least("low", "q_low").alias("low")), "jump")
        reached = now
    names = jump.select(F.col("p").alias("on")).distinct()
    ring = stage(jump.join(names, F.col("id") == F.col("on"), "left_semi").join(stuck.select(F.col("id").alias("me"), "parent"), F.col("id") == F.col("me")).select("id", "parent", "p", "low"), "ring")
    while True:  # every node on a loop has one before it: no hot keys
        beside = ring.select(F.col("id").alias("q"), F.col("low").alias("q_low"))
        if ring.join(beside, F.col("parent") == F.col("q")).where("low <> q_low").isEmpty():
            break
        to = ring.select(F.col("id").alias("q"), F.col("p").alias("q_p"), F.col("low").alias("q_low"))
        ring = stage(ring.join(to, F.col("p") == F.col("q")).select("id", "parent", F.col("q_p").alias("p"), F.least("low", "q_low").alias("low")), "ring")
    stuck = stuck.drop("p", "low")
    tail = lambda: [F.lit(None).cast("long").alias("subtree"), *(["payload"] if fold else [])]
    lows = ring.select(F.col("id").alias("on"), "low")
    on = stuck.join(lows, F.col("id") == F.col("on")).select("id", F.col("low").alias("root"), F.lit(0).cast("long").alias("depth"), F.lit("cycle").alias("state"), "n_children", *tail(), *([fold.own().alias("ride")] if fold else []))
    # below: the ring cut open is a forest whose tops are the ring's nodes
    below = stuck.join(lows, F.col("id") == F.col("on"), "left_anti").withColumn("d", F.lit(1).cast("long"))
    hot = _hot(below, "parent", n)
    shut = F.col("low").isNull()
    walk = Staged(lookup_join(below, lows, F.col("parent") == F.col("on"), "parent", "on", hot).select("id", "payload", "n_children", F.col("parent").alias("p"), "d", "low", *([fold.own().alias("ride")] if fold else [])), "walk", open=shut)
    while walk.counts["open"]:
        open_ = walk.df.where(shut)
        to = walk.df.select(F.col("id").alias("q"), F.col("p").alias("q_p"), F.col("d").alias("q_d"), F.col("low").alias("q_low"), *([F.col("ride").alias("q_ride")] if fold else []))
        moved = lookup_join(open_, to, F.col("p") == F.col("q"), "p", "q", _hot(open_, "p", n), "inner").select("id", "payload", "n_children", F.col("q_p").alias("p"), (F.col("d") + F.col("q_d")).alias("d"), F.col("q_low").alias("low"), *([fold.join(F.col("q_ride"), F.col("ride")).alias("ride")] if fold else []))
        new = Staged(walk.df.where(~shut).unionByName(moved), "walk", open=shut)
        walk.drop()
        walk = new
    off = walk.df.select("id", F.col("low").alias("root"), F.col("d").alias("depth"), F.lit("below_cycle").alias("state"), "n_children", *tail(), *(["ride"] if fold else []))
    return on.unionByName(off)


#: Numbers added up from the root down.
SUM = Ride(lambda: F.col("payload").cast("long"), lambda up, low: up + low)


def intervals(nodes: DataFrame) -> DataFrame:
    """``(id, root, enter, exit)`` for ``nodes (id, parent)`` that aren't on or below loops: the descendants of a node are those
    of the same root whose enter lies behind its own, up to its exit.

    All descendants in one row a node, whatever a tree's shape, where a list or all pairs would grow with depth. A walk
    through each tree, siblings by id, would meet its nodes in the order of enter, from 0. A node enters one step behind
    its parent and behind all nodes below its earlier siblings, so the numbers are sums along the ways up; sizes of
    siblings are added by ``running_sum``, which gathers no family.
    """
    nodes = stage(nodes.select("id", "parent"), "nodes")
    sized = stage(resolve_trees(nodes.withColumn("payload", F.lit(None).cast("string")), with_sizes=True).where("state in ('whole', 'lost')").select("id", "root", "subtree"), "sized")
    family = nodes.join(sized, "id").where("id <> root").select("id", "parent", "subtree")
    steps = running_sum(family, ["parent"], ["id"], "subtree", "upto").select("id", (F.col("upto") - F.col("subtree") + 1).cast("string").alias("payload"))
    whole = nodes.join(steps, "id", "left").select("id", "parent", F.coalesce("payload", F.lit("0")).alias("payload"))
    placed = resolve_trees(whole, ride=SUM).where("state in ('whole', 'lost')").select("id", F.col("ride").alias("enter"))
    return sized.join(placed, "id").select("id", "root", "enter", (F.col("enter") + F.col("subtree") - 1).alias("exit"))


def descendants(resolved: DataFrame) -> DataFrame:
    """``(ancestor, descendant, distance)`` for every pair of a node and a node below it, from ``resolved`` with paths of ids."""
    n = F.size("path")
    return resolved.select("id", F.posexplode(F.slice("path", 1, F.greatest(n - 1, F.lit(0)))).alias("i", "ancestor"), n.alias("n")).select("ancestor", F.col("id").alias("descendant"), (F.col("n") - 1 - F.col("i")).alias("distance"))
