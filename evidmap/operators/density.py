"""Clusters of varying density (M2) from a graph of neighbours.

The weight of an edge is the mutual reachability of its ends: the largest of their distance and
their core distances. A minimum spanning forest of it holds all that the hierarchy needs; it comes
from Boruvka rounds, each a few joins over components. The hierarchy is then built from the lightest
edge up, again by rounds over components that join where each is the other's nearest:

- *Small* components (under ``min_cluster_size`` points) grow until they are clusters. One whose
  nearest edges lead to a cluster falls to it at the weight of its own edge, however long the way,
  so a chain of small ones takes a logarithm of rounds.
- *Clusters* join in pairs. The stability of a cluster is settled when it joins another: the points
  that fell to it before, each by the inverse of the weight at which it fell, against that of the join.
  A chain of clusters joins one by one, so when no more than ``ONE_TASK`` edges are left, one task
  joins them in their order (a forest of so few is grown by one task too); what fell to them is dealt over tasks that look up where it belongs.

Of a cluster and those within it, the side of higher stability stays. What is collected are counts.
Edges of equal weight are taken in the order of their ends, so every result is settled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evidmap.runtime import stored

NOISE = -1
LEAST_WEIGHT = 1e-12  # of equal points, whose inverse has no bound
# Edges between the components, or clusters, of a round that one task takes to the end.
ONE_TASK = 200_000
# Events that one task places in a tree of so many.
EVENTS_A_TASK = 200_000


def core_distances(graph: DataFrame, min_points: int) -> DataFrame:
    """(id, core): distance to the ``min_points``-th neighbour, or the last there is."""
    last = F.least(F.size("neighbours"), F.lit(min_points))
    core = F.when(last > 0, F.get("neighbours", last - 1)["distance"]).otherwise(F.lit(0.0))
    return graph.select("id", core.alias("core"))


def mutual_reachability(graph: DataFrame, min_points: int = 10) -> DataFrame:
    """(a, b, weight), a < b, of every pair in ``graph`` (id, neighbours by distance)."""
    cores = core_distances(graph, min_points)
    pairs = graph.select("id", F.inline("neighbours").alias("distance", "other"))
    pairs = pairs.where(F.col("id") != F.col("other")).groupBy(
        F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")
    )
    pairs = pairs.agg(F.min("distance").alias("distance"))
    for end in ("a", "b"):
        own = cores.select(F.col("id").alias(end), F.col("core").alias(f"core_{end}"))
        pairs = pairs.join(own, end)
    weight = F.greatest("distance", "core_a", "core_b", F.lit(LEAST_WEIGHT))
    return pairs.select("a", "b", weight.alias("weight"))


def _key() -> Column:
    """The order of edges: by weight, then by their ends."""
    return F.struct("weight", "a", "b").alias("key")


def _nearest(edges: DataFrame) -> DataFrame:
    """(part, key, other): the first edge of each part of ``edges`` (part_a, part_b, key)."""
    ends = F.array(
        F.struct(F.col("part_a").alias("part"), "key", F.col("part_b").alias("other")),
        F.struct(F.col("part_b").alias("part"), "key", F.col("part_a").alias("other")),
    )
    first = F.min(F.struct("key", "other")).alias("first")
    return edges.select(F.inline(ends)).groupBy("part").agg(first).select("part", "first.*")


def _relabelled(edges: DataFrame, moved: DataFrame) -> DataFrame:
    """``edges`` between the parts after ``moved`` (part, to); those within a part go."""
    for end in ("part_a", "part_b"):
        to = moved.select(F.col("part").alias(end), "to")
        edges = edges.join(to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    return edges.where("part_a != part_b")


def _last_of_way(hooks: DataFrame) -> DataFrame:
    """(part, to): where the ways of ``hooks`` (part, to) end; an end points to itself or has no
    row. Each step doubles the known way; two of them are one job."""
    ways = hooks.select("part", "to")

    def doubled(ways: DataFrame) -> DataFrame:
        ahead = ways.select(F.col("part").alias("to"), F.col("to").alias("further"))
        return ways.join(ahead, "to", "left").select(
            "part", F.coalesce("further", "to").alias("to"), (F.col("further") != F.col("to")).alias("moved")
        )

    while True:
        longer = stored(doubled(doubled(ways).drop("moved")))
        ways = longer.select("part", "to")
        if longer.where("moved").isEmpty():
            return ways


def _rest_of_forest(edges: DataFrame) -> DataFrame:
    """The edges that join components, taken one by one in their order, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def find(part):
            while part in up:
                up[part] = part = up.get(up[part], up[part])
            return part

        for batch in batches:
            taken = []
            for at, (a, b) in enumerate(zip(batch.column("part_a").to_pylist(), batch.column("part_b").to_pylist())):
                a, b = find(a), find(b)
                if a != b:
                    up[a] = b
                    taken.append(at)
            key = batch.column("key").take(pa.array(taken, pa.int64()))
            yield pa.RecordBatch.from_arrays([key], ["key"])

    schema = edges.select("key").schema
    return edges.repartition(1).sortWithinPartitions("key").mapInArrow(run, schema).select("key.*")


def spanning_forest(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """The minimum spanning forest of ``edges`` (a, b, weight), by Boruvka rounds.

    In a round every component takes its first edge; edges between the same two components
    are folded to the first of them. When no more than ``one_task`` edges are left, one task
    takes them in their order: the forest is the same.
    """
    schema = edges.select("a", "b", "weight").schema
    open_ = stored(edges.select(F.col("a").alias("part_a"), F.col("b").alias("part_b"), _key()))
    chosen = []
    while True:
        if open_.limit(one_task + 1).count() <= one_task:
            chosen.append(_rest_of_forest(open_))
            break
        nearest = stored(_nearest(open_))
        chosen.append(nearest.select("key").distinct().select("key.*"))
        # two components that take the same edge: the lesser one is the end of the way
        back = nearest.select(F.col("part").alias("other"), F.col("key").alias("back"))
        hooks = nearest.join(back, "other").select(
            "part",
            F.when((F.col("key") == F.col("back")) & (F.col("part") < F.col("other")), F.col("part"))
            .otherwise(F.col("other"))
            .alias("to"),
        )
        left = _relabelled(open_, _last_of_way(hooks))
        pair = (F.least("part_a", "part_b"), F.greatest("part_a", "part_b"))
        left = left.groupBy(pair[0].alias("p"), pair[1].alias("q")).agg(F.min("key").alias("key"))
        open_ = stored(left.select(F.col("p").alias("part_a"), F.col("q").alias("part_b"), "key"))
    forest = edges.sparkSession.createDataFrame([], schema)
    for some in chosen:
        forest = forest.unionByName(some.select("a", "b", "weight"))
    return forest


def _mutual(nearest: DataFrame) -> DataFrame:
    """(part, other, key), part < other: pairs that are each other's nearest."""
    back = nearest.select(F.col("part").alias("other"), F.col("other").alias("part"))
    return nearest.join(back, ["part", "other"]).where("part < other")


def _grown_by_one(points: DataFrame, forest: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What ``_grown`` gives, of a forest that one task takes edge by edge."""
    kind = points.schema["id"].dataType.simpleString()
    names = ["what", "id", "part", "size", "weight", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}
        members: dict = {}  # of the components that are small
        part: dict = {}  # the first cluster of a point
        rows: list[tuple] = []
        types = None

        def find(id_):
            while id_ in up:
                up[id_] = id_ = up.get(up[id_], up[id_])
            return id_

        for batch in batches:
            types = batch.column("a").type
            for key in zip(*[batch.column(c).to_pylist() for c in ("weight", "a", "b")]):
                _, a, b = key
                root_a, root_b = find(a), find(b)
                own_a, own_b = ([r] if r == p and p not in part and r not in members else members.pop(r, None) for r, p in ((root_a, a), (root_b, b)))
                up[root_b] = root_a
                if own_a is None and own_b is None:
                    rows.append(("edge", part[a], part[b], 0, *key))
                    continue
                if own_a is not None and own_b is not None:
                    both = own_a + own_b
                    if len(both) < least:
                        members[root_a] = both
                        continue
                    to, fallen = min(both), both
                    rows.append(("cluster", None, to, len(both), *key))
                else:
                    to, fallen = (part[b], own_a) if own_b is None else (part[a], own_b)
                for id_ in fallen:
                    part[id_] = to
                    rows.append(("point", id_, to, 0, *key))
        if rows:
            kinds = [pa.string(), types, types, pa.int64(), pa.float64(), types, types]
            for at in range(0, len(rows), 50_000):
                columns = [pa.array(c, t) for c, t in zip(zip(*rows[at : at + 50_000]), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    dealt = forest.select("weight", "a", "b").repartition(1).sortWithinPartitions("weight", "a", "b")
    schema = f"what string, id {kind}, part {kind}, size bigint, weight double, a {kind}, b {kind}"
    found = stored(dealt.mapInArrow(run, schema))

    def of(what: str) -> DataFrame:
        return found.where(F.col("what") == what)

    placed = points.select("id").join(of("point").select("id", "part", _key()), "id", "left")
    return (
        stored(placed.select("id", F.coalesce("part", "id").alias("part"), "key")),
        of("cluster").select("part", "size", _key()),
        of("edge").select(F.col("id").alias("part_a"), F.col("part").alias("part_b"), _key()),
    )


def _grown(points: DataFrame, forest: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Points, clusters and edges once every component has ``least`` points, or no edge left.

    points: (id, part, key): the first cluster the point is in, and the edge by which it fell
    to it (null key: in none). clusters: (part, size, key) as they first had ``least`` points.
    edges: (part_a, part_b, key) between clusters.
    """
    kind = forest.select(_key()).schema["key"].dataType.simpleString()
    none = F.lit(None).cast(kind)
    points = points.select("id", F.col("id").alias("part"), none.alias("key"))
    parts = points.groupBy("part").agg(F.count("*").alias("size")).withColumn("key", none)
    edges = forest.select(F.col("a").alias("part_a"), F.col("b").alias("part_b"), _key())
    parts, edges = stored(parts), stored(edges)
    while True:
        small = parts.where(F.col("size") < least).select("part", "size")
        nearest = stored(_nearest(edges).join(small, "part"))
        if nearest.isEmpty():
            break
        # a way of nearest edges ends at a cluster or at two small ones that are mutual
        mutual = _mutual(nearest.select("part", "other", "key"))
        ends = mutual.select("part", F.col("part").alias("to"))
        paired = mutual.select(F.col("other").alias("part"), F.col("part").alias("to"))
        hooks = ends.unionByName(paired).unionByName(
            nearest.select("part", F.col("other").alias("to")).join(ends.unionByName(paired), "part", "left_anti")
        )
        large = parts.where(F.col("size") >= least).select(F.col("part").alias("to"))
        fallen = _last_of_way(hooks).join(large, "to").join(nearest.select("part", "key"), "part")
        joined = mutual.select(F.explode(F.array("part", "other")).alias("part"), F.col("part").alias("to"), "key")
        moved = stored(
            fallen.select("part", "to", "key", F.lit(True).alias("falls")).unionByName(
                joined.select("part", "to", "key", F.lit(False).alias("falls"))
            )
        )
        points = stored(
            points.join(moved.withColumnRenamed("key", "by"), "part", "left").select(
                "id", F.coalesce("to", "part").alias("part"), F.coalesce("key", F.when(F.col("falls"), F.col("by"))).alias("key")
            )
        )
        # a cluster keeps the size and edge of its beginning; what falls to it is an event
        merged = moved.where("NOT falls").join(small, "part").groupBy(F.col("to").alias("part"))
        merged = merged.agg(F.sum("size").alias("size"), F.first("key").alias("key"))
        parts = stored(
            parts.join(moved.select("part"), "part", "left_anti").unionByName(merged.select("part", "size", "key"))
        )
        edges = stored(_relabelled(edges, moved.select("part", "to")))
    clusters = parts.where(F.col("size") >= least)
    # points of a cluster's beginning leave it at its first edge
    begun = clusters.select("part", F.col("key").alias("begin"))
    points = points.join(begun, "part", "left").select("id", "part", F.coalesce("key", "begin").alias("key"))
    return stored(points), stored(clusters), edges


def _inverse(key: str) -> Column:
    return F.lit(1.0) / F.col(key)["weight"]


def _joins(edges: DataFrame, clusters: DataFrame, number: int) -> DataFrame:
    """(node, parent, until): ``clusters`` (part, node) joined by ``edges`` in their order, in one task.

    Parents are of the rounds after ``number``; the last of a tree has no parent.
    """
    kind = clusters.schema["part"].dataType.simpleString()
    until = edges.schema["key"].dataType.simpleString()
    for end in ("a", "b"):
        own = clusters.select(F.col("part").alias(f"part_{end}"), F.col("node.round").alias(f"round_{end}"))
        edges = edges.join(own, f"part_{end}")
    names = ["round", "part", "parent_round", "parent_part", "until"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}
        made: dict = {}  # the round in which the cluster of a part was made, if it was here

        def find(part):
            while part in up:
                up[part] = part = up.get(up[part], up[part])
            return part

        last, kinds = number, None
        for batch in batches:
            kinds = [batch.column("part_a").type, batch.column("key").type]
            rows, at = [], []
            ends = zip(*[batch.column(c).to_pylist() for c in ("part_a", "round_a", "part_b", "round_b")])
            for place, (a, round_a, b, round_b) in enumerate(ends):
                a, b = find(a), find(b)
                last += 1
                to = min(a, b)
                rows += [(made.get(a, round_a), a, last, to), (made.get(b, round_b), b, last, to)]
                at += [place, place]
                up[max(a, b)] = to
                made[to] = last
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), kinds[0]] * 2)]
            if rows:
                yield pa.RecordBatch.from_arrays([*columns, batch.column("key").take(pa.array(at))], names)
        roots = [p for p in made if p not in up]
        if roots:
            own = [pa.array([made[p] for p in roots], pa.int32()), pa.array(roots, kinds[0])]
            none = [pa.nulls(len(roots), t) for t in (pa.int32(), *kinds)]
            yield pa.RecordBatch.from_arrays([*own, *none], names)

    dealt = edges.select("part_a", "round_a", "part_b", "round_b", "key").repartition(1).sortWithinPartitions("key")
    joined = dealt.mapInArrow(run, f"round int, part {kind}, parent_round int, parent_part {kind}, until {until}")
    parent = F.when(F.col("parent_round").isNotNull(), F.struct(F.col("parent_round").alias("round"), F.col("parent_part").alias("part")))
    return joined.select(F.struct("round", "part").alias("node"), parent.alias("parent"), "until")


def _fallen(events: DataFrame, joins: DataFrame, tasks: int) -> DataFrame:
    """(node, more, more_mass): what falls to each node of ``joins`` before it joins another.

    ``events`` (node, key, n): ``node`` is where the way up begins. Every task has the whole of
    ``joins`` and goes up by powers of two.
    """
    kind = joins.schema["node"].dataType["part"].dataType.simpleString()

    def place(events: pa.Table, joins: pa.Table) -> pa.Table:
        def nodes(column: str) -> list:
            return list(zip(*[joins.column(f"{column}_{c}").to_pylist() for c in ("round", "part")]))

        own = nodes("node")
        at = {node: i for i, node in enumerate(own)}
        ways = [np.array([at.get(p, i) for i, p in enumerate(nodes("parent"))], np.int64)]
        while (ways[-1] != ways[-1][ways[-1]]).any():
            ways.append(ways[-1][ways[-1]])
        ways = [w.tolist() for w in ways]
        ends = zip(*[joins.column(c).to_pylist() for c in ("weight", "a", "b")])
        until = [(math.inf,) if key[0] is None else key for key in ends]
        more: dict[int, int] = {}
        mass: dict[int, float] = {}
        for round_, part, weight, a, b, n in zip(*[events.column(c).to_pylist() for c in ("round", "part", "weight", "a", "b", "n")]):
            key, node = (weight, a, b), at[round_, part]
            if until[node] < key:
                for way in reversed(ways):
                    if until[way[node]] < key:
                        node = way[node]
                node = ways[0][node]
            more[node] = more.get(node, 0) + n
            mass[node] = mass.get(node, 0.0) + n / weight
        found = [own[i] for i in more]
        parts = pa.array([p for _, p in found], joins.column("node_part").type)
        columns = [pa.array([r for r, _ in found], pa.int32()), parts, pa.array(list(more.values()), pa.int64())]
        return pa.table([*columns, pa.array([mass[i] for i in more], pa.float64())], ["round", "part", "more", "more_mass"])

    dealt = events.select("node.*", "key.*", "n").withColumn("task", F.pmod(F.xxhash64("part", "a", "b"), F.lit(tasks)))
    whole = joins.select(
        *[F.col(f"{c}.{f}").alias(f"{c}_{f}") for c in ("node", "parent") for f in ("round", "part")],
        "until.*",
        F.explode(F.sequence(*[F.lit(t).cast("bigint") for t in (0, tasks - 1)])).alias("task"),
    )
    found = dealt.groupBy("task").cogroup(whole.groupBy("task")).applyInArrow(
        place, f"round int, part {kind}, more bigint, more_mass double"
    )
    return found.groupBy(F.struct("round", "part").alias("node")).agg(
        F.sum("more").alias("more"), F.sum("more_mass").alias("more_mass")
    )


def _rest_of_tree(open_: DataFrame, events: DataFrame, edges: DataFrame, number: int) -> DataFrame:
    """The tree (node, parent, until, size, stability, chosen) of the clusters that ``edges`` join."""
    joins = stored(_joins(edges, open_, number))
    events = stored(
        events.join(open_.select("part", "node"), "part").join(
            joins.select("node"), "node", "left_semi"
        ).select("node", "key", "n")
    )
    tasks = max(1, math.ceil(events.count() / EVENTS_A_TASK))
    begun = open_.select("node", "size", "mass", "within")
    rows = joins.join(begun, "node", "left").join(_fallen(events, joins, tasks), "node", "left")
    schema = joins.schema.simpleString()[len("struct<") : -1] + ",size:double,stability:double,chosen:boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict = {}  # size, the better sides and the weight of the join, of a cluster made here

        def ends(column: pa.Array) -> list:
            return [None if v is None else (v["round"], v["part"]) for v in column.to_pylist()]

        for batch in batches:
            found = []
            weights = [None if v is None else v["weight"] for v in batch.column("until").to_pylist()]
            own = zip(*[batch.column(c).to_pylist() for c in ("size", "mass", "within", "more", "more_mass")])
            for node, parent, weight, (size, mass, within, more, more_mass) in zip(
                ends(batch.column("node")), ends(batch.column("parent")), weights, own
            ):
                if size is None:
                    size, within, joined = made.pop(node)
                    mass = size / joined
                size, mass = size + (more or 0), mass + (more_mass or 0.0)
                stability = mass - (0.0 if weight is None else size / weight)
                chosen = within is None or stability >= within
                found.append((size, stability, chosen))
                if parent is not None:
                    size_, within_, _ = made.get(parent, (0.0, 0.0, None))
                    made[parent] = size_ + size, within_ + (stability if chosen else within), weight
            columns = [batch.column(c) for c in ("node", "parent", "until")]
            columns += [pa.array(c) for c in zip(*found)] if found else []
            if found:
                yield pa.RecordBatch.from_arrays(columns, ["node", "parent", "until", "size", "stability", "chosen"])

    # both sides of a join come before what they make
    dealt = rows.repartition(1).sortWithinPartitions(F.asc_nulls_last("until"))
    return stored(dealt.mapInArrow(run, schema))


def condensed_tree(
    points: DataFrame, forest: DataFrame, min_cluster_size: int = 10, one_task: int = ONE_TASK
) -> tuple[DataFrame, DataFrame]:
    """The tree of clusters and the place of every point in it.

    First (node, parent, until, size, stability, chosen): ``until`` is the edge (weight, a, b) by
    which the cluster joins another to become ``parent``; ``chosen``: it is the more stable
    side of itself and those within it. Second (id, part, key): ``node`` (0, part) is the first
    cluster the point is in, ``key`` the edge by which it fell to it; both null for noise.
    ``points`` has the column id, ``forest`` (a, b, weight) joins them.
    """
    if min_cluster_size < 2:
        raise ValueError("a cluster has two points or more")
    few = forest.limit(one_task + 1).count() <= one_task
    placed, clusters, edges = (_grown_by_one if few else _grown)(points, forest, min_cluster_size)
    begun = clusters.select("part", F.lit(True).alias("begun"))
    placed = stored(
        placed.join(begun, "part", "left").select(
            "id", F.when(F.col("begun"), F.col("part")).alias("part"), F.when(F.col("begun"), F.col("key")).alias("key")
        )
    )
    one_tree = clusters.count() == edges.count() + 1 and placed.where("part IS NULL").isEmpty()
    # what falls to a cluster after its beginning
    events = placed.join(clusters.select("part", F.col("key").alias("begin")), "part").where(
        F.col("key") != F.col("begin")
    )
    events = stored(
        events.groupBy("part", "key").agg(F.count("*").alias("n"))
    )
    open_ = clusters.select(
        "part",
        F.struct(F.lit(0).alias("round"), "part").alias("node"),
        F.col("size").cast("double").alias("size"),
        (F.col("size") * _inverse("key")).alias("mass"),
        F.lit(None).cast("double").alias("within"),
    )
    settled, number = [], 0

    def closed(parts: DataFrame, fell: DataFrame, birth: Column) -> DataFrame:
        """``parts`` with all that fell to them, their stability, and the better side."""
        sums = fell.groupBy("part").agg(
            F.sum("n").alias("more"), F.sum(F.col("n") * _inverse("key")).alias("more_mass")
        )
        size = F.col("size") + F.coalesce("more", F.lit(0))
        mass = F.col("mass") + F.coalesce("more_mass", F.lit(0.0))
        full = parts.join(sums, "part", "left").withColumns({"size": size, "mass": mass})
        full = full.withColumn("stability", F.col("mass") - F.col("size") * birth)
        chosen = F.col("within").isNull() | (F.col("stability") >= F.col("within"))
        best = F.when(chosen, F.col("stability")).otherwise(F.col("within"))
        return full.withColumns({"chosen": chosen, "best": best})

    left = edges.limit(one_task + 1).count()
    while left > one_task:
        number += 1
        pairs = _mutual(_nearest(edges))
        moved = pairs.select(
            F.explode(F.array("part", "other")).alias("part"),
            F.col("part").alias("to"),
            F.col("key").alias("until"),
        )
        moved = stored(moved)
        fell = events.join(moved, "part").where(F.col("key") < F.col("until"))
        joining = closed(open_.join(moved, "part"), fell.select("part", "key", "n"), _inverse("until"))
        joining = stored(
            joining.withColumn("parent", F.struct(F.lit(number).alias("round"), F.col("to").alias("part")))
        )
        settled.append(joining.select("node", "parent", "until", "size", "stability", "chosen"))
        merged = joining.groupBy(F.col("to").alias("part"), F.col("parent").alias("node"), "until").agg(
            F.sum("size").alias("size"), F.sum("best").alias("within")
        )
        merged = merged.select("part", "node", "size", (F.col("size") * _inverse("until")).alias("mass"), "within")
        open_ = stored(open_.join(moved, "part", "left_anti").unionByName(merged))
        rest = events.join(moved, "part", "left").where("until IS NULL OR key > until")
        rest = rest.select(F.coalesce("to", "part").alias("part"), "key", "n")
        events = stored(rest.groupBy("part", "key").agg(F.sum("n").alias("n")))
        edges = stored(_relabelled(edges, moved.select("part", "to")))
        left = edges.limit(one_task + 1).count()
    if left:
        settled.append(_rest_of_tree(open_, events, edges, number))
        rest = settled[-1]
        if one_tree:  # the whole is no cluster
            settled[-1] = rest.withColumn("chosen", F.col("chosen") & F.col("parent").isNotNull())
        open_ = open_.join(rest.select("node"), "node", "left_anti")
    last = closed(open_, events, F.lit(0.0))
    if one_tree:  # the whole is no cluster
        last = last.withColumn("chosen", F.lit(False))
    tree = last.select(
        "node",
        F.lit(None).cast(last.schema["node"].dataType).alias("parent"),
        F.lit(None).cast(forest.select(_key()).schema["key"].dataType).alias("until"),
        "size",
        "stability",
        "chosen",
    )
    for some in settled:
        tree = tree.unionByName(some)
    return stored(tree.withColumn("size", F.col("size").cast("bigint"))), placed


def _outermost(tree: DataFrame) -> DataFrame:
    """(node, top, until): the outermost chosen cluster a node lies in, itself included."""
    own = F.when(F.col("chosen"), F.struct("node", "until"))
    ways = stored(tree.select("node", F.col("parent").alias("up"), own.alias("top")))
    while not ways.where("up IS NOT NULL").isEmpty():
        ahead = ways.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("top").alias("above"))
        ways = stored(
            ways.join(ahead, "up", "left").select("node", F.col("next").alias("up"), F.coalesce("above", "top").alias("top"))
        )
    return ways.where("top IS NOT NULL").select("node", F.col("top.node").alias("top"), "top.until")


def density_tree_clusters(
    graph: DataFrame, min_points: int = 10, min_cluster_size: int = 10, one_task: int = ONE_TASK
) -> DataFrame:
    """M2: (id, cluster) of every point of ``graph`` (id, neighbours by distance).

    Clusters may differ in density; points in none are noise (-1). They are numbered from 0 in
    the order of their least id. Points whose neighbours do not connect them are in trees of
    their own.
    """
    points = graph.select("id")
    forest = stored(spanning_forest(mutual_reachability(graph, min_points), one_task))
    tree, placed = condensed_tree(points, forest, min_cluster_size, one_task)
    top = _outermost(tree).where(F.col("node.round") == 0)
    top = top.select(F.col("node.part").alias("part"), "top", "until")
    inside = placed.join(top, "part").where("until IS NULL OR key < until").select("id", "top")
    first = inside.groupBy("top").agg(F.min("id").alias("first"))
    # one row per cluster reaches this window
    number = (F.row_number().over(W.orderBy("first")) - 1).cast("bigint")
    inside = inside.join(first.select("top", number.alias("cluster")), "top").select("id", "cluster")
    noise = F.lit(NOISE).cast("bigint")
    return points.join(inside, "id", "left").select("id", F.coalesce("cluster", noise).alias("cluster"))
