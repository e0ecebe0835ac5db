"""Hierarchies of points: HDBSCAN labels (D4), GLOSH scores (D5), DWOF scores.

Two points of a group are as far apart as their mutual reachability: the
largest of their distance and their core distances (to the ``k``-th nearest
record, the point itself and repeated coordinates counted).  Components of
points within a falling distance form the hierarchy.

1. *Core distances* come from the exact kNN join (J11) of ``NEAR`` neighbours or
   more; its pairs are also the first known edges.
2. *Spanning tree* by Borůvka rounds: every component takes its least outgoing
   edge (a grouped minimum), chosen edges join components (pointer jumping).  Of
   the known edges between two components the least is kept.  A known
   edge is taken as it is if no point of the component could have a shorter
   unknown one; only the others search, by branch and bound over the cube
   pyramid.  Boxes of one component are dropped whole, and bounds are shared by
   all points of a component, so a large component looks across its edge only.
   All components at least halve each round.
3. *Levels.*  The tree is cut at its median edge again and again (light edges:
   one piece per component; heavy edges: a tree of those components) until each
   piece has at most ``PIECE_EDGES`` edges; a task walks through the edges of a
   piece in order.  Equal distances merge at once, so the result does not depend
   on which of several spanning trees was found.  A piece of equal edges only is
   one merge and needs no walk (grouped sums), however large it is.
4. *Condensed tree* (HDBSCAN): components below ``min_cluster_size`` records fall
   out of the cluster that they would join; joins of two or more clusters begin
   a new one.  Stabilities are grouped sums; the choice between a cluster and
   those below it goes up with chains of single clusters taken at once (pointer
   jumping), so rounds grow with the logarithm of the tree, not with its depth; the
   choice of the topmost chosen one comes down by pointer jumping.

DWOF grows windows around all points by one factor a step; its components are
those of the same tree over "the step at which two points meet" instead of the
mutual reachability.

No group is in one task, and nothing but counts reaches the driver.

Densities are whole numbers (10^18 / millimetres), so stabilities are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from occuflow.functions.geo import EARTH_RADIUS_M, SPHEROID_BAND, ecef
from occuflow.operators import knn
from occuflow.session import cut_lineage, keyed_join, ship_package, spread

# Neighbours of a point at least that are known to the spanning tree from the start.
NEAR = 8
# Edges of a piece that one task walks through.
PIECE_EDGES = 200_000
# Cubes of at most this many points are searched point by point.
LEAF_POINTS = 8
# No further round of a search for this many pairs in all.
LEAF_PAIRS = 200_000
DENSITY_UNIT = 10 ** 18
_FAR = (1 << 62)  # no bound (millimetres)


def _density(mm: str) -> F.Column:
    """Density level of a distance; coincident records are twice as dense as one millimetre."""
    return F.expr(f"CASE WHEN {mm} = 0 THEN {2 * DENSITY_UNIT}L ELSE {DENSITY_UNIT}L div {mm} END")


def group_key(column: str) -> F.Column:
    """A NULL group is a group of its own."""
    return (F.when(F.col(column).isNull(), F.lit(""))
             .otherwise(F.concat(F.lit("="), F.col(column).cast("string"))))


def _numbered(points: DataFrame, key: str, lat: str, lon: str, weight: str | None) -> DataFrame:
    """The points with their group ``_k``, a number ``_n`` and a weight ``_w``, written once."""
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return cut_lineage(points.withColumns({
        "_k": group_key(key), "_n": F.monotonically_increasing_id(), "_w": w,
        "_lat": F.col(lat).cast("double"), "_lon": F.col(lon).cast("double")}))


def core_distances(numbered: DataFrame, k: int, geomodel: str) -> tuple[DataFrame, DataFrame]:
    """(points with ``_core``, ``_radius``; known edges).

    ``_core`` (mm) is NULL in groups of fewer than ``k`` records; all points
    within ``_radius`` are among the known edges ``(_k, _a, _b, _w)``, ``_a < _b``.
    """
    near = max(k - 1, NEAR)
    sites = numbered.select("_k", "_n", "_w", "_lat", "_lon")
    pairs = cut_lineage(
        keyed_join(knn.knn_candidates(sites, near, "_k", "_n", "_lat", "_lon", geomodel),
                   sites.select(F.col("_k"), F.col("_n").alias("_nid"), F.col("_w").alias("_nw")), ["_k", "_nid"])
        .select("_k", F.col("_id").alias("_n"), "_nid", "_nw", "_dmm"))
    by = W.partitionBy("_k", "_n").orderBy("_dmm")
    ranked = (pairs.withColumn("_r", F.row_number().over(W.partitionBy("_k", "_n").orderBy("_dmm", "_nid")))
              .withColumn("_sum", F.sum("_nw").over(by)))
    facts = (keyed_join(ranked, sites.select("_k", "_n", "_w"), ["_k", "_n"]).groupBy("_k", "_n").agg(
        F.min(F.when(F.col("_sum") + F.col("_w") >= k, F.col("_dmm"))).alias("_far"),
        F.min(F.when(F.col("_r") == near, F.col("_dmm"))).alias("_kth")))
    x, y, z = ecef("_lat", "_lon")
    points = cut_lineage(keyed_join(sites, facts, ["_k", "_n"], "left")
                         .withColumn("_core", F.when(F.col("_w") >= k, F.lit(0).cast("long")).otherwise(F.col("_far")))
                         .withColumn("_radius", F.coalesce("_kth", F.lit(_FAR)))
                         .withColumn("_x", x).withColumn("_y", y).withColumn("_z", z).drop("_far", "_kth"))
    core = points.where("_core IS NOT NULL").select("_k", F.col("_n"), "_core", "_radius")
    known = (keyed_join(keyed_join(pairs, core, ["_k", "_n"]).where(F.col("_dmm") <= F.col("_radius")),
                        core.select("_k", F.col("_n").alias("_nid"), F.col("_core").alias("_ncore")), ["_k", "_nid"])
             .select("_k", F.least("_n", "_nid").alias("_a"), F.greatest("_n", "_nid").alias("_b"),
                     F.greatest("_dmm", "_core", "_ncore").alias("_w")).distinct())
    return points, cut_lineage(known)


# ------------------------------------------------------------------ spanning tree

_EDGE = ("_w", "_a", "_b")


class Reachability:
    """Edges weigh the mutual reachability (mm); ``_core`` is the core distance."""

    def __init__(self, geomodel: str):
        self.geomodel = geomodel
        self.band = SPHEROID_BAND if geomodel == "wgs84" else 0.0

    def reach(self) -> F.Column:
        """Metres within which an edge below the bound ``_best`` lies."""
        return F.col("_best") / 1000.0 * (1 + 2 * self.band) + 1.0

    def unknown(self) -> F.Column:
        """What an unknown edge of a point weighs at least."""
        return F.greatest("_radius", "_core")

    def least(self) -> F.Column:
        """What an edge from the point into the box weighs at least."""
        return F.greatest("_core", "_low", F.floor(knn.box_distance(False) * (1000.0 * (1 - self.band)) - 20).cast("long"))

    def _far(self) -> F.Column:
        chord = F.least(knn.box_distance(True) / (2 * EARTH_RADIUS_M), F.lit(1.0))
        return F.asin(chord) * (2 * EARTH_RADIUS_M * (1 + self.band)) + 0.02

    def most(self) -> F.Column:
        """What the least edge from the point to a point of the box weighs at most."""
        return F.greatest("_core", "_high", F.ceil(self._far() * 1000.0).cast("long"))

    def weight(self, mm, other: str) -> F.Column:
        return F.greatest(mm, "_core", other)


class Meeting(Reachability):
    """Edges weigh the step at which the larger of two growing windows holds both points.

    ``_core`` is a point's first radius (m), ``_span`` the largest of its group.
    """

    def __init__(self, geomodel: str, delta: float):
        super().__init__(geomodel)
        self.delta = delta

    def step(self, metres, radius) -> F.Column:
        grown = F.ceil(F.log(metres / radius) / F.lit(math.log(self.delta)) - F.lit(1e-9))
        return F.when(metres > 0, F.greatest(grown.cast("long"), F.lit(1).cast("long"))).otherwise(F.lit(1).cast("long"))

    def reach(self) -> F.Column:
        return F.col("_span") * F.pow(F.lit(self.delta), F.col("_best")) * (1 + 2 * self.band) + 1.0

    def unknown(self) -> F.Column:
        return F.col("_radius")

    def least(self) -> F.Column:
        return self.step(knn.box_distance(False) * (1 - self.band) - 0.02, F.greatest("_core", "_high"))

    def most(self) -> F.Column:
        return self.step(self._far(), F.greatest("_core", "_low"))

    def weight(self, mm, other: str) -> F.Column:
        return self.step(mm / F.lit(1000.0), F.greatest("_core", other))


def _pyramid(state: DataFrame, deepest: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(points per level, boxes, boxes by parent), each box with its components and core distances."""
    lv = knn.cube_levels(state.select("_k", "_n", "_c", "_core", "_lat", "_lon", "_x", "_y", "_z"), 0, deepest)
    boxes = cut_lineage(lv.groupBy(*knn.NODE).agg(
        F.count(F.lit(1)).alias("_m"), F.min("_c").alias("_c0"), F.max("_c").alias("_c1"),
        F.min("_core").alias("_low"), F.max("_core").alias("_high"),
        *[f(a).alias(f"{a}{i}") for a in ("_x", "_y", "_z") for i, f in ((0, F.min), (1, F.max))]))
    facts = ["_m", "_c0", "_c1", "_low", "_high", *knn.BOX]
    below = boxes.select("_k", (F.col("_lv") - 1).alias("_lv"),
                         *[F.floor(F.col(c) / 2 ** knn.STEP).cast("long").alias(c) for c in knn.NODE[2:]],
                         F.struct(*knn.NODE[1:], *facts).alias("_child"))
    return lv, boxes, below


def _search(need: DataFrame, state: DataFrame, measure: Reachability, deepest: int) -> DataFrame:
    """The least edge ``(_k, _c, _w, _a, _b, _o)`` to another component below the bound ``_best``.

    ``need``: points of ``state`` with their component's bound; every one of
    them that could have a shorter edge looks for it.  ``deepest``: the first
    level of small boxes only.
    """
    lv, boxes, below = _pyramid(state, deepest)
    query = ["_k", "_n", "_c", "_core", "_lat", "_lon", "_x", "_y", "_z"]
    facts = ["_m", "_c0", "_c1", "_low", "_high", *knn.BOX]
    reach = F.least(measure.reach(), F.lit(knn.top_side()))
    level = F.least(F.greatest(F.floor(F.log(F.lit(knn.top_side()) / reach) / F.log(F.lit(2.0 ** knn.STEP))),
                               F.lit(0)), F.lit(deepest)).cast("int")
    frontier = keyed_join(knn.cubes_in_reach(need.withColumn("_lv", level), reach)
                          .select(*query, "_best", *knn.NODE[1:]), boxes, knn.NODE)
    found = []
    for _ in range(knn.LEVELS + 1):
        foreign = (F.col("_c0") != F.col("_c")) | (F.col("_c1") != F.col("_c"))
        step = cut_lineage(frontier.where(foreign).withColumn("_least", measure.least())
                           .withColumn("_most", measure.most() + 1).where(F.col("_least") < F.col("_best")))
        # the bound of a component: an edge into the box that is nearest by its far corner
        bound = step.groupBy("_k", "_c").agg(F.min("_most").alias("_bound"))
        live = (keyed_join(step, bound, ["_k", "_c"]).withColumn("_best", F.least("_best", "_bound"))
                .where(F.col("_least") < F.col("_best")))
        small = (F.col("_m") <= LEAF_POINTS) | (F.col("_lv") == deepest)
        found.append(live.where(small).select(*query, "_best", *knn.NODE[1:]))
        split = live.where(~small)
        pairs = split.agg(F.sum("_m")).first()[0] or 0
        if pairs <= LEAF_PAIRS:  # few in all: test their points at once
            found.append(split.select(*query, "_best", *knn.NODE[1:]))
            break
        frontier = (keyed_join(split.select(*query, "_best", *knn.NODE[1:]), below, knn.NODE)
                    .select(*query, "_best", *[F.col(f"_child.{c}").alias(c) for c in (*knn.NODE[1:], *facts)]))
    ends = found[0]
    for f in found[1:]:
        ends = ends.unionByName(f)
    members = lv.select(*knn.NODE, F.col("_n").alias("_o_n"), F.col("_c").alias("_o"), F.col("_core").alias("_o_core"),
                        F.col("_lat").alias("_o_lat"), F.col("_lon").alias("_o_lon"))
    mm = knn._dist_mm("_lat", "_lon", "_o_lat", "_o_lon", measure.geomodel)
    pairs = (keyed_join(ends, members, knn.NODE).where(F.col("_c") != F.col("_o"))
             .select("_k", "_c", measure.weight(mm, "_o_core").alias("_w"),
                     F.least("_n", "_o_n").alias("_a"), F.greatest("_n", "_o_n").alias("_b"), "_o"))
    return _least_edges(pairs)


def _least_edges(edges: DataFrame) -> DataFrame:
    """The least edge of each component, ties by the ends."""
    return (edges.groupBy("_k", "_c").agg(F.min(F.struct(*_EDGE, "_o")).alias("_e"))
            .select("_k", "_c", *[F.col(f"_e.{c}").alias(c) for c in (*_EDGE, "_o")]))


def _joined_components(chosen: DataFrame) -> DataFrame:
    """(_k, _c, _root): the components that the chosen edges join.

    Every component has chosen one edge, so edges lead into a ring: mostly two
    components that chose each other, but searches stop at the bound, so
    several may chase each other along equally long edges.  Pointer jumping with
    the least component on the way names each by the least one of its ring; it
    ends when the names agree along all edges.
    """
    path = chosen.select("_k", "_c", "_o", F.col("_o").alias("_to"), F.col("_c").alias("_low"))
    while True:
        path = cut_lineage(path)
        there = path.select("_k", F.col("_c").alias("_to"), F.col("_to").alias("_next"), F.col("_low").alias("_root"))
        path = cut_lineage(keyed_join(path, there, ["_k", "_to"]).select(
            "_k", "_c", "_o", F.col("_next").alias("_to"), F.least("_low", "_root").alias("_low"), "_root"))
        names = path.select("_k", "_c", "_root")
        if keyed_join(path.select("_k", "_o", F.col("_root").alias("_mine")), names.withColumnRenamed("_c", "_o"),
                      ["_k", "_o"]).where("_mine <> _root").isEmpty():
            return names
        path = path.drop("_root")


def spanning_edges(points: DataFrame, known: DataFrame, measure: Reachability) -> DataFrame:
    """(_k, _a, _b, _w): a minimum spanning tree per group.

    Among equally long edges a ring may be left in it, which joins nothing that
    is not joined at that length anyway.

    ``points`` and ``known`` as :func:`core_distances` returns them; points
    without a core distance take no part.
    """
    state = points.where("_core IS NOT NULL").withColumn("_c", F.col("_n")).drop("_w")
    known = known.where("_a <> _b").select("_k", *_EDGE, F.col("_a").alias("_ca"), F.col("_b").alias("_cb"))
    tree, roots, deepest = None, None, None
    while True:
        state = cut_lineage(state)
        if deepest is None:
            deepest = knn.deepest_level(state, LEAF_POINTS)
        open_groups = state.groupBy("_k").agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi")).where("_lo < _hi").select("_k")
        state = state.join(open_groups, "_k", "left_semi")
        if roots is not None:
            # the least known edge between two components stands for all
            at = lambda c, r: roots.select("_k", F.col("_c").alias(c), F.col("_root").alias(r))
            known = cut_lineage(
                keyed_join(keyed_join(known, at("_ca", "_ra"), ["_k", "_ca"]), at("_cb", "_rb"), ["_k", "_cb"])
                .where("_ra <> _rb").groupBy("_k", F.least("_ra", "_rb").alias("_ca"), F.greatest("_ra", "_rb").alias("_cb"))
                .agg(F.min(F.struct(*_EDGE)).alias("_e")).select("_k", *[F.col(f"_e.{c}").alias(c) for c in _EDGE], "_ca", "_cb"))
        both = known.select("_k", F.col("_ca").alias("_c"), *_EDGE, F.col("_cb").alias("_o")).unionByName(
            known.select("_k", F.col("_cb").alias("_c"), *_EDGE, F.col("_ca").alias("_o")))
        best = _least_edges(both)
        need = cut_lineage(keyed_join(state, best.select("_k", "_c", F.col("_w").alias("_best")), ["_k", "_c"], "left")
                           .withColumn("_best", F.coalesce("_best", F.lit(_FAR)))
                           .where(measure.unknown() < F.col("_best")))
        if not need.isEmpty():
            searched = need.select("_k").distinct()
            more = _search(need, state.join(searched, "_k", "left_semi"), measure, deepest)
            best = _least_edges(both.unionByName(more))
        best = cut_lineage(best)
        if best.isEmpty():
            break
        new = best.select("_k", *_EDGE).distinct()
        tree = new if tree is None else tree.unionByName(new)
        roots = _joined_components(best)
        settled = best.select("_k", "_c", F.col("_w").alias("_upto"))
        state = (keyed_join(state, keyed_join(settled, roots, ["_k", "_c"]), ["_k", "_c"])
                 .withColumn("_radius", F.greatest("_radius", "_upto")).withColumn("_c", F.col("_root"))
                 .drop("_upto", "_root"))
    if tree is None:
        return known.select("_k", *_EDGE).limit(0)
    return cut_lineage(tree.distinct())


# ------------------------------------------------------------------ pieces

def _halves(nodes: DataFrame, edges: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Cut pieces of more than ``limit`` edges at their median edge until none is left.

    ``nodes``: (_g, _k, _node, _size, _least, _core, _top, _inner); ``edges``:
    (_g, _a, _b, _w).  ``_inner`` names the piece that a node stands for, ``_top``
    is its longest edge.  Returns the nodes and edges of all pieces.
    """
    while True:
        facts = edges.groupBy("_g").agg(
            F.count(F.lit(1)).alias("_m"), F.min("_w").alias("_w0"), F.max("_w").alias("_w1"),
            F.percentile_approx("_w", 0.5, 1000).alias("_mid"))
        large = facts.where((F.col("_m") > limit) & (F.col("_w0") < F.col("_w1")))
        if large.isEmpty():
            return nodes, edges
        below = edges.join(facts.select("_g", "_w1"), "_g").where("_w < _w1").groupBy("_g").agg(F.max("_w").alias("_under"))
        pivot = cut_lineage(large.join(below, "_g").select("_g", F.least("_mid", "_under").alias("_t")))
        part = edges.join(pivot, "_g", "left")
        light = cut_lineage(part.where("_w <= _t").select("_g", *_EDGE))
        label = components(light.select(F.col("_g").alias("_k"), F.col("_a").alias("src"), F.col("_b").alias("dst")))
        label = label.select(F.col("_k").alias("_g"), F.col("node").alias("_node"), F.col("label").alias("_label"))
        piece = F.concat("_g", F.lit("/"), F.col("_label"))
        touched = keyed_join(nodes, label, ["_g", "_node"], "left").join(pivot, "_g", "left")
        inside = touched.where("_label IS NOT NULL")
        lower = inside.select(piece.alias("_g"), "_k", "_node", "_size", "_least", "_core", "_top", "_inner")
        at = lambda c: label.select("_g", F.col("_node").alias(c), F.col("_label").alias(f"{c}_l"))
        labelled = keyed_join(light, at("_a"), ["_g", "_a"])
        longest = labelled.groupBy("_g", F.col("_a_l").alias("_label")).agg(F.max("_w").alias("_top"))
        merged = (inside.groupBy("_g", "_k", "_label").agg(
                      F.sum("_size").alias("_size"), F.min("_least").alias("_least"), F.max("_core").alias("_core"))
                  .join(longest, ["_g", "_label"])
                  .select(F.concat("_g", F.lit("^")).alias("_g"), "_k", F.col("_label").alias("_node"), "_size", "_least",
                          "_core", "_top", piece.alias("_inner")))
        alone = touched.where("_label IS NULL AND _t IS NOT NULL").select(
            F.concat("_g", F.lit("^")).alias("_g"), "_k", "_node", "_size", "_least", "_core", "_top", "_inner")
        rest = touched.where("_t IS NULL").select("_g", "_k", "_node", "_size", "_least", "_core", "_top", "_inner")
        nodes = cut_lineage(lower.unionByName(merged).unionByName(alone).unionByName(rest))
        low = labelled.select(F.concat("_g", F.lit("/"), "_a_l").alias("_g"), *_EDGE)
        high = (keyed_join(keyed_join(part.where("_w > _t"), at("_a"), ["_g", "_a"], "left"), at("_b"), ["_g", "_b"], "left")
                .select(F.concat("_g", F.lit("^")).alias("_g"), "_w", F.coalesce("_a_l", "_a").alias("_a"),
                        F.coalesce("_b_l", "_b").alias("_b")))
        edges = cut_lineage(low.unionByName(high).unionByName(part.where("_t IS NULL").select("_g", *_EDGE)))


def _whole(piece: str = "_g") -> F.Column:
    """The name by which the pieces above know a piece, whichever of its halves is meant."""
    return F.regexp_replace(piece, r"\^+$", "")


def components(edges: DataFrame) -> DataFrame:
    from occuflow.operators.density import connected_components

    return connected_components(edges)


class Node(NamedTuple):
    """A point of a piece, or the piece ``inner`` that stands for its points."""

    size: int
    least: int
    core: float
    top: int
    inner: str | None


class _Walk:
    """Union-find over the nodes of a piece, a level (edges of equal length) at a time."""

    def __init__(self, nodes: dict[int, Node]):
        self.nodes = nodes
        self.up = {n: n for n in nodes}

    def root(self, n: int) -> int:
        up = self.up
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    def levels(self, edges: list[tuple[int, int, int]]) -> Iterator[tuple[int, dict[int, list[int]]]]:
        """(distance, {new root: the roots it joins}) of sorted ``(w, a, b)``."""
        i = 0
        while i < len(edges):
            w, parts = edges[i][0], set()
            j = i
            while j < len(edges) and edges[j][0] == w:
                parts.add(self.root(edges[j][1]))
                parts.add(self.root(edges[j][2]))
                j += 1
            for _, a, b in edges[i:j]:
                self.up[self.root(a)] = self.root(b)
            joined: dict[int, list[int]] = {}
            for p in parts:
                joined.setdefault(self.root(p), []).append(p)
            yield w, joined
            i = j


def _glosh_walk(g: str, k: str, nodes: dict[int, Node], edges: list, m: int) -> Iterator[tuple]:
    """A row per point that first joins others at its own core distance: the least one there."""
    walk = _Walk(nodes)
    least = {n: v.least for n, v in nodes.items()}
    for w, joined in walk.levels(edges):
        for root, parts in joined.items():
            low = min(least[p] for p in parts)
            for p in parts:
                if nodes[p].core == w and nodes[p].inner is None:
                    yield g, k, "least", str(p), None, low, 0, 0.0
            least[root] = low


def _condense_walk(g: str, k: str, nodes: dict[int, Node], edges: list, m: int) -> Iterator[tuple]:
    """Rows (g, k, kind, what, cluster, w, size): points and pieces that fall, clusters that join, the one on top."""
    walk = _Walk(nodes)
    size = {n: v.size for n, v in nodes.items()}
    cluster: dict[int, str | None] = {}
    members: dict[int, list[int]] = {n: [n] for n in nodes}
    for n, v in nodes.items():
        # a piece of enough records has a cluster of its own; so have enough records of one place
        cluster[n] = None if v.size < m else "s" + v.inner if v.inner is not None else f"c{g}.{n}"
    count = 0

    def fall(part: int, into: str, w: int) -> Iterator[tuple]:
        for n in members.pop(part):
            v = nodes[n]
            yield g, k, "fall", (v.inner if v.inner is not None else str(n)), into, w, v.size, 0.0

    def own(part: int, w: int) -> bool:
        """Whether a part is a cluster already below level ``w``."""
        place = len(members.get(part, ())) == 1 and nodes[part].inner is None
        return cluster[part] is not None and not (place and nodes[part].core >= w)

    began = set()

    def begun(part: int) -> Iterator[tuple]:
        """The records of one place fall out of their cluster at its core distance."""
        if nodes[part].inner is None and cluster[part] == f"c{g}.{part}" and part not in began:
            began.add(part)
            yield g, k, "fall", str(part), cluster[part], nodes[part].core, nodes[part].size, 0.0
            members.pop(part, None)

    for w, joined in walk.levels(edges):
        for root, parts in joined.items():
            total = sum(size[p] for p in parts)
            big = [p for p in parts if own(p, w)]
            small = [p for p in parts if not own(p, w)]
            for p in big:
                yield from begun(p)
            if total < m:
                into = None
                kept = [n for p in parts for n in members.pop(p)]
                members[root] = kept
            else:
                if len(big) == 1:
                    into = cluster[big[0]]
                else:
                    count += 1
                    into = f"c{g}#{count}"
                    for p in big:
                        yield g, k, "link", cluster[p], into, w, size[p], 0.0
                for p in small:
                    yield from fall(p, into, w)
                for p in big:
                    members.pop(p, None)
                members[root] = []
            size[root], cluster[root] = total, into
    tops = {walk.root(n) for n in nodes}
    for t in tops:
        if len(nodes) == 1 and nodes[t].inner is None and cluster[t] is not None:
            yield from begun(t)
        yield g, k, "top", g.rstrip("^"), cluster[t], 0, size[t], 0.0


_EVENTS = "_g string, _k string, kind string, what string, cluster string, w long, size long, value double"


def _walked(nodes: DataFrame, edges: DataFrame, walk: Callable, m: int) -> DataFrame:
    """Events of all pieces; a piece's nodes, then its edges in order, pass through one task."""
    none = F.lit(None).cast("long")
    rows = nodes.select("_g", "_k", F.lit(0).alias("_kind"), "_size", F.col("_node").alias("_a"), none.alias("_b"),
                        "_least", "_core", "_top", "_inner").unionByName(
        edges.select("_g", F.lit(None).cast("string").alias("_k"), F.lit(1).alias("_kind"), F.col("_w").alias("_size"), "_a", "_b",
                     *[none.alias(c) for c in ("_least", "_core", "_top")], F.lit(None).cast("string").alias("_inner")))
    dealt = spread(rows, "_g").sortWithinPartitions("_g", "_kind", "_size")
    names = ["_g", "_k", "kind", "what", "cluster", "w", "size", "value"]
    kinds = [pa.string()] * 5 + [pa.int64()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, key, held, lines, out = None, None, {}, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
            out.clear()

        for batch in batches:
            for g, k, kind, size, a, b, *facts in zip(*[c.to_pylist() for c in batch.columns]):
                if g != at:
                    if at is not None:
                        out.extend(walk(at, key, held, lines, m))
                    at, key, held, lines = g, k, {}, []
                if kind == 0:
                    held[a] = Node(size, *facts)
                else:
                    lines.append((size, a, b))
            yield from flush()
        if at is not None:
            out.extend(walk(at, key, held, lines, m))
        yield from flush()

    return cut_lineage(dealt.mapInArrow(run, _EVENTS))


def _pieces(points: DataFrame, tree: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    # hexadecimal, so that no group's name looks like a piece of another
    whole = F.concat(F.lit("g"), F.hex("_k"))
    nodes = points.where("_core IS NOT NULL").select(
        whole.alias("_g"), "_k", F.col("_n").alias("_node"), F.col("_w").alias("_size"), F.col("_core").alias("_least"),
        "_core", F.lit(0).cast("long").alias("_top"), F.lit(None).cast("string").alias("_inner"))
    return _halves(nodes, tree.select(whole.alias("_g"), *_EDGE), limit)


def _hierarchy(points: DataFrame, k: int, key: str, lat: str, lon: str, geomodel: str, weight: str | None
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(numbered points, their core distances, the spanning tree)."""
    if k is None or isinstance(k, bool) or int(k) != k or k < 1:
        raise ValueError("the number of records of a core distance must be a positive integer")
    ship_package(points.sparkSession)
    numbered = _numbered(points, key, lat, lon, weight)
    sites, known = core_distances(numbered, k, geomodel)
    return numbered, sites, spanning_edges(sites, known, Reachability(geomodel))


# ------------------------------------------------------------------ GLOSH

def glosh(points: DataFrame, k: int, key: str = "Species", pid: str = "H3", lat: str = "LAT", lon: str = "LON",
          geomodel: str = "sphere", weight: str | None = None, piece_edges: int = PIECE_EDGES) -> DataFrame:
    """GLOSH scores (D5) of the hierarchy with clusters of one object and more.

    A point is in its cluster down to its own core distance; its score is one
    less the least core distance in its component at that level, divided by its
    own (Campello et al. 2015 with a minimum cluster size of one).  0 for points
    that join nothing at their own level, for coincident records and in groups
    of fewer than ``k`` records.  ``k`` counts the point itself.
    """
    numbered, sites, tree = _hierarchy(points, k, key, lat, lon, geomodel, weight)
    scores = (keyed_join(sites.select("_n", "_core"), least_cores(sites, tree, piece_edges), "_n", "left")
              .select("_n", F.when((F.col("_core") > 0) & F.col("_low").isNotNull(),
                                   F.lit(1.0) - F.col("_low") / F.col("_core")).otherwise(F.lit(0.0)).alias("OutlierScore")))
    return keyed_join(numbered, scores, "_n").select(*points.columns, "OutlierScore")


def least_cores(sites: DataFrame, tree: DataFrame, piece_edges: int = PIECE_EDGES) -> DataFrame:
    """(_n, _low): the least core distance in a point's component at its own, if it has joined others there."""
    nodes, edges = _pieces(sites, tree, piece_edges)
    facts = edges.groupBy("_g").agg(F.count(F.lit(1)).alias("_m"))
    large = facts.where(F.col("_m") > piece_edges).select("_g")  # equal edges only: one level
    least = _walked(nodes.join(large, "_g", "left_anti"), edges.join(large, "_g", "left_anti"), _glosh_walk, 1).select(
        F.col("what").cast("long").alias("_n"), F.col("w").alias("_low"))
    level = edges.join(large, "_g", "left_semi").groupBy("_g").agg(F.min("_w").alias("_level"))
    flat = nodes.join(level, "_g")
    low = flat.groupBy("_g").agg(F.min("_least").alias("_low"))
    return least.unionByName(flat.join(low, "_g").where(F.col("_core") == F.col("_level")).select(
        F.col("_node").alias("_n"), "_low"))


# ------------------------------------------------------------------ HDBSCAN

def _flat_events(nodes: DataFrame, level: DataFrame, m: int) -> DataFrame:
    """The events of pieces whose edges are all equal: everything joins at once."""
    inner = F.col("_inner")
    own = (F.col("_size") >= m) & (inner.isNotNull() | (F.col("_core") < F.col("_level")))
    flat = nodes.join(level, "_g").withColumn("_own", F.when(own, F.when(inner.isNotNull(), F.concat(F.lit("s"), inner))
                                              .otherwise(F.concat(F.lit("c"), "_g", F.lit("."), F.col("_node")))))
    total = flat.groupBy("_g").agg(F.count("_own").alias("_big"), F.sum("_size").alias("_total"), F.max("_own").alias("_one"))
    into = (F.when(F.col("_total") < m, F.lit(None)).when(F.col("_big") == 1, F.col("_one"))
            .otherwise(F.concat(F.lit("c"), "_g", F.lit("#1"))))
    total = total.withColumn("_into", into)
    rows = flat.join(total, "_g")
    cols = lambda kind, what, cluster, w, size: [
        F.col("_g"), F.col("_k"), F.lit(kind).alias("kind"), what.alias("what"), cluster.alias("cluster"),
        w.alias("w"), size.alias("size"), F.lit(0.0).alias("value")]
    falls = rows.where("_into IS NOT NULL AND _own IS NULL").select(*cols(
        "fall", F.coalesce("_inner", F.col("_node").cast("string")), F.col("_into"), F.col("_level"), F.col("_size")))
    places = rows.where("_own IS NOT NULL AND _inner IS NULL").select(*cols(
        "fall", F.col("_node").cast("string"), F.col("_own"), F.col("_core"), F.col("_size")))
    links = rows.where("_own IS NOT NULL AND _big > 1").select(*cols(
        "link", F.col("_own"), F.col("_into"), F.col("_level"), F.col("_size")))
    tops = total.join(flat.select("_g", "_k").distinct(), "_g").select(*cols(
        "top", _whole(), F.col("_into"), F.lit(0).cast("long"), F.col("_total")))
    return falls.unionByName(places).unionByName(links).unionByName(tops)


def _resolved(events: DataFrame) -> DataFrame:
    """Events with clusters named by themselves instead of by the piece they are on top of."""
    tops = cut_lineage(events.where("kind = 'top' AND cluster IS NOT NULL").select(
        F.concat(F.lit("s"), "what").alias("_piece"), "cluster"))
    while not tops.where("cluster LIKE 's%'").isEmpty():
        tops = cut_lineage(tops.join(tops.select(F.col("_piece").alias("cluster"), F.col("cluster").alias("_up")), "cluster", "left")
                           .select("_piece", F.coalesce("_up", "cluster").alias("cluster")))
    rows = events.where("kind <> 'top'")
    for c in ("cluster", "what"):
        rows = (rows.join(tops.select(F.col("_piece").alias(c), F.col("cluster").alias("_real")), c, "left")
                .withColumn(c, F.coalesce("_real", c)).drop("_real"))
    return rows.select("_k", "kind", "what", "cluster", "w", "size")


def _fallen_points(falls: DataFrame, nodes: DataFrame) -> DataFrame:
    """(_k, _n, cluster, w): pieces that fell replaced by their points."""
    inside = nodes.select(_whole().alias("_g"), F.coalesce("_inner", F.col("_node").cast("string")).alias("_member"))
    done, rows = None, falls.select("_k", "what", "cluster", "w")
    while True:
        rows = cut_lineage(rows)
        points = rows.where(rows["what"].rlike("^[0-9]+$")).select("_k", F.col("what").cast("long").alias("_n"), "cluster", "w")
        done = points if done is None else done.unionByName(points)
        rest = rows.where(~rows["what"].rlike("^[0-9]+$"))
        if rest.isEmpty():
            return done
        rows = (rest.join(inside, rest["what"] == inside["_g"])
                .select("_k", F.col("_member").alias("what"), "cluster", "w"))


def _down_chains(left: DataFrame) -> DataFrame:
    """Clusters with their value ``_a``: the larger of the stability and what the clusters below are worth.

    A cluster above a single other one is worth ``greatest(_a, _b + value of
    _next)``; these chains are followed by pointer jumping, so their length
    costs rounds by its logarithm only.  ``_open``: two or more clusters are
    unjudged below, here or at the end of the chain.
    """
    chain = F.col("_kids") == 1
    path = cut_lineage(left.select(
        "cluster", "parent", "stability", "_below", F.coalesce(F.col("_kids") > 1, F.lit(False)).alias("_open"),
        F.when(chain, F.col("stability")).otherwise(F.greatest("stability", "_below")).alias("_a"),
        F.when(chain, F.col("_below")).alias("_b"), F.when(chain, F.col("_only")).alias("_next")))
    while not path.where("_next IS NOT NULL").isEmpty():
        there = path.select(F.col("cluster").alias("_next"), F.col("_a").alias("_na"), F.col("_b").alias("_nb"),
                            F.col("_next").alias("_nn"), F.col("_open").alias("_no"))
        plus = lambda c: (F.col("_b") + F.col(c)).cast("decimal(38,0)")
        path = cut_lineage(keyed_join(path, there, "_next", "left").select(
            "cluster", "parent", "stability", "_below", (F.col("_open") | F.coalesce("_no", F.lit(False))).alias("_open"),
            F.greatest("_a", plus("_na")).alias("_a"), plus("_nb").alias("_b"), F.col("_nn").alias("_next")))
    return path


def _chosen(clusters: DataFrame) -> DataFrame:
    """(cluster, top): the topmost chosen cluster at or above each, by excess of mass.

    ``clusters``: (cluster, parent, stability).  A cluster without a parent
    (all of a group) is never chosen; a tie goes to the larger cluster.
    """
    zero = F.lit(0).cast("decimal(38,0)")
    left, done = cut_lineage(clusters.withColumn("_below", zero)), None
    while not left.isEmpty():
        kids = (left.where("parent IS NOT NULL").groupBy(F.col("parent").alias("cluster"))
                    .agg(F.count(F.lit(1)).alias("_kids"), F.min("cluster").alias("_only")))
        path = _down_chains(keyed_join(left, kids, "cluster", "left"))
        judged = path.where("NOT _open").select("cluster", "parent",
                                                (F.col("parent").isNotNull() & (F.col("_a") == F.col("stability"))).alias("chosen"))
        done = judged if done is None else done.unionByName(judged)
        passed = (path.where("NOT _open AND parent IS NOT NULL").groupBy(F.col("parent").alias("cluster"))
                      .agg(F.sum("_a").cast("decimal(38,0)").alias("_more")))
        left = cut_lineage(keyed_join(path.where("_open"), passed, "cluster", "left").select(
            "cluster", "parent", "stability", (F.col("_below") + F.coalesce("_more", zero)).cast("decimal(38,0)").alias("_below")))
    if done is None:
        return clusters.select("cluster", F.col("cluster").alias("top"))
    up = cut_lineage(done.select("cluster", F.col("parent").alias("_up"), F.when(F.col("chosen"), F.col("cluster")).alias("top")))
    while not up.where("_up IS NOT NULL").isEmpty():
        above = up.select(F.col("cluster").alias("_up"), F.col("_up").alias("_next"), F.col("top").alias("_higher"))
        up = cut_lineage(up.join(above, "_up", "left").select("cluster", F.col("_next").alias("_up"),
                                                              F.coalesce("_higher", "top").alias("top")))
    return up.select("cluster", "top")


def hdbscan_labels(points: DataFrame, min_samples: int, min_cluster_size: int = 5, key: str = "Species",
                   pid: str = "H3", lat: str = "LAT", lon: str = "LON", geomodel: str = "sphere",
                   weight: str | None = None, piece_edges: int = PIECE_EDGES) -> DataFrame:
    """HDBSCAN cluster labels (D4): ``cluster`` (-1 = noise) and ``cluster_rep``.

    Clusters are chosen by excess of mass; a whole group is never one cluster.
    ``min_samples`` counts the point itself; ``weight`` is a multiplicity, so
    repeated records count one by one.  ``cluster_rep`` is the smallest id of
    the cluster (NULL for noise), ``cluster`` a non-negative number derived from
    it.  Groups of fewer than ``min_samples`` records are noise; a NULL group is
    a group of its own.  (key, pid) must be unique.
    """
    m = min_cluster_size
    if m is None or isinstance(m, bool) or int(m) != m or m < 2:
        raise ValueError("min_cluster_size must be an integer of 2 or more")
    numbered, sites, tree = _hierarchy(points, min_samples, key, lat, lon, geomodel, weight)
    member = condensed_clusters(sites, tree, m, piece_edges)
    labelled = keyed_join(numbered, member, "_n", "left")
    rep = labelled.where("top IS NOT NULL").groupBy("top").agg(F.min(pid).alias("cluster_rep"))
    number = F.xxhash64(F.col("_k"), F.col("cluster_rep").cast("string")).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
    return (labelled.join(rep, "top", "left")
            .withColumn("cluster", F.when(F.col("cluster_rep").isNull(), F.lit(-1).cast("long")).otherwise(number))
            .select(*points.columns, "cluster", "cluster_rep"))


def condensed_clusters(sites: DataFrame, tree: DataFrame, m: int, piece_edges: int = PIECE_EDGES) -> DataFrame:
    """(_n, top): the chosen cluster of every point that has one."""
    nodes, edges = _pieces(sites, tree, piece_edges)
    facts = edges.groupBy("_g").agg(F.count(F.lit(1)).alias("_m"), F.min("_w").alias("_level"))
    large = facts.where(F.col("_m") > piece_edges).select("_g", "_level")
    walked = _walked(nodes.join(large, "_g", "left_anti"), edges.join(large, "_g", "left_anti"), _condense_walk, m)
    events = cut_lineage(_resolved(walked.unionByName(_flat_events(nodes, large, m))))
    links = events.where("kind = 'link'").select("_k", F.col("what").alias("cluster"), F.col("cluster").alias("parent"), "w", "size")
    falls = events.where("kind = 'fall'")
    fallen = cut_lineage(_fallen_points(falls, nodes))
    names = fallen.select("cluster").union(links.select("cluster")).union(links.select("parent")).distinct()
    birth = links.select("cluster", "parent", _density("w").alias("_birth"))
    clusters = names.join(birth, "cluster", "left")
    ends = (falls.select("cluster", "w", "size").unionByName(links.select(F.col("parent").alias("cluster"), "w", "size"))
            .join(clusters.select("cluster", F.coalesce("_birth", F.lit(0).cast("long")).alias("_birth")), "cluster"))
    mass = ends.groupBy("cluster").agg(
        F.sum((_density("w") - F.col("_birth")).cast("decimal(19,0)") * F.col("size").cast("decimal(12,0)"))
        .cast("decimal(38,0)").alias("stability"))
    top = _chosen(clusters.join(mass, "cluster").select("cluster", "parent", "stability"))
    return fallen.join(top.where("top IS NOT NULL"), "cluster").select("_n", "top")


# ------------------------------------------------------------------ DWOF

def first_radii(points: DataFrame, k: int, geomodel: str) -> tuple[DataFrame, DataFrame]:
    """(points with ``_core`` (m), ``_span``, ``_radius``; known edges by metres).

    A first radius is the mean distance among the ``k`` nearest (and their ties)
    of a point, scaled so that the least of a group is its least distance.
    ``_core`` is NULL in groups in which no point has two neighbours.
    """
    sites = points.select("_k", "_n", "_lat", "_lon")
    pairs = cut_lineage(knn.knn(sites, k, "_k", "_n", "_lat", "_lon", geomodel).select(
        "_k", "_n", "nid", F.floor(F.col("dist_m") * 1000.0 + 0.5).cast("long").alias("_dmm"), "rank"))
    place = sites.select("_k", F.col("_n").alias("nid"), "_lat", "_lon")
    around = keyed_join(pairs.select("_k", "_n", "nid"), place, ["_k", "nid"])
    other = around.select("_k", "_n", F.col("nid").alias("_o"), F.col("_lat").alias("_o_lat"), F.col("_lon").alias("_o_lon"))
    among = (keyed_join(around, other, ["_k", "_n"]).where(F.col("nid") < F.col("_o"))
             .select("_k", "_n", knn._dist_mm("_lat", "_lon", "_o_lat", "_o_lon", geomodel).alias("_mm")))
    mean = cut_lineage(among.groupBy("_k", "_n").agg((F.sum("_mm") / F.count(F.lit(1)) / 1000.0).alias("_mean"),
                                                     F.min(F.when(F.col("_mm") > 0, F.col("_mm"))).alias("_near")))
    scale = mean.groupBy("_k").agg(F.min("_mean").alias("_low"), (F.min("_near") / 1000.0).alias("_unit"))
    radius = (F.when(F.col("_unit").isNull(), F.lit(1.0))  # all coincide
              .when(F.col("_low") > 0, F.col("_mean") * F.col("_unit") / F.col("_low")).otherwise(F.col("_unit")))
    radii = mean.join(scale, "_k").select("_k", "_n", radius.alias("_core"))
    span = radii.groupBy("_k").agg(F.max("_core").alias("_span"))
    known = pairs.groupBy("_k", "_n").agg(F.max(F.when(F.col("rank") >= k, F.col("_dmm"))).alias("_kth"))
    x, y, z = ecef("_lat", "_lon")
    return (keyed_join(keyed_join(sites, radii, ["_k", "_n"], "left").join(span, "_k", "left"), known, ["_k", "_n"], "left")
            .withColumn("_x", x).withColumn("_y", y).withColumn("_z", z)), pairs


def _dwof_walk(g: str, k: str, nodes: dict[int, Node], edges: list, m: int) -> Iterator[tuple]:
    """What every node gathers in its piece; ``core`` is the last step of the group."""
    walk = _Walk(nodes)
    size = {n: v.size for n, v in nodes.items()}
    born = {n: v.top for n, v in nodes.items()}
    members = {n: [n] for n in nodes}
    value, shared = dict.fromkeys(nodes, 0.0), dict.fromkeys(nodes, 0.0)
    for w, joined in walk.levels(edges):
        for root, parts in joined.items():
            total = sum(size[p] for p in parts)
            for p in parts:
                shared[p] += gathered(size[p], born[p], w, total, nodes[p].core)
            # the longest list takes the others, whose own sums are set off against its
            parts.sort(key=lambda p: len(members[p]))
            largest, base = members.pop(parts[-1]), shared[parts[-1]]
            for p in parts[:-1]:
                for n in members.pop(p):
                    value[n] += shared[p] - base
                    largest.append(n)
            members[root], shared[root] = largest, base
            size[root], born[root] = total, w
    whole = "/" not in g
    for root, held in members.items():
        last = gathered(size[root], born[root], nodes[root].core + 1, None, nodes[root].core) if whole else 0.0
        for n in held:
            inner = nodes[n].inner
            yield g, k, "value", inner if inner is not None else str(n), None, 0, 0, value[n] + shared[root] + last


def gathered(size: int, born: int, w: int, total: int | None, last: int) -> float:
    """What the members of a component gather from its birth until it joins others at step ``w``."""
    if size <= 1 or born >= min(w, last + 1):
        return 0.0
    steps = min(w - 1, last) - born
    return steps * (size - 1) / size + ((size - 1) / total if total and w <= last else 0.0)


def _flat_values(nodes: DataFrame, level: DataFrame) -> DataFrame:
    """:func:`_dwof_walk` of pieces whose edges are all equal."""
    flat = nodes.join(level, "_g")
    total = flat.groupBy("_g").agg(F.sum("_size").alias("_total"))
    size, last, w = F.col("_size"), F.col("_core"), F.col("_level")
    own = F.when((size > 1) & (F.col("_top") < F.least(w, last + 1)),
                 (F.least(w - 1, last) - F.col("_top")) * (size - 1) / size
                 + F.when(w <= last, (size - 1) / F.col("_total")).otherwise(0.0)).otherwise(0.0)
    after = F.when(~F.col("_g").contains("/") & (w <= last),
                   (last - w) * (F.col("_total") - 1) / F.col("_total")).otherwise(0.0)
    return flat.join(total, "_g").select("_g", F.coalesce("_inner", F.col("_node").cast("string")).alias("what"),
                                         (own + after).alias("value"))


def growth_sums(sites: DataFrame, tree: DataFrame, piece_edges: int = PIECE_EDGES) -> DataFrame:
    """(_n, value): sums over the steps until no point of a group is alone.

    ``tree`` weighs the steps at which points meet; a step adds (size before -
    1) / (size now) of a point's component.
    """
    ends = tree.select("_k", F.col("_a").alias("_n"), "_w").unionByName(tree.select("_k", F.col("_b").alias("_n"), "_w"))
    last = ends.groupBy("_k", "_n").agg(F.min("_w").alias("_w")).groupBy("_k").agg(F.max("_w").alias("_last"))
    single = (sites.where("_core IS NOT NULL").join(last, "_k")
              .select("_k", "_n", F.lit(1).cast("long").alias("_w"), F.col("_last").alias("_core")))
    nodes, edges = _pieces(single, tree, piece_edges)
    facts = edges.groupBy("_g").agg(F.count(F.lit(1)).alias("_m"), F.min("_w").alias("_level"))
    large = facts.where(F.col("_m") > piece_edges).select("_g", "_level")
    walked = _walked(nodes.join(large, "_g", "left_anti"), edges.join(large, "_g", "left_anti"), _dwof_walk, 1)
    values = cut_lineage(walked.select("_g", "what", "value").unionByName(_flat_values(nodes, large))
                         .withColumn("_g", _whole()))
    digits = F.col("what").rlike("^[0-9]+$")
    # what a piece gathered as a node of the piece above it, summed up to the top
    up = cut_lineage(values.where(~digits).select(F.col("what").alias("_piece"), F.col("_g").alias("_above"), "value"))
    while True:
        above = up.select(F.col("_piece").alias("_above"), F.col("_above").alias("_next"), F.col("value").alias("_more"))
        step = cut_lineage(up.join(above, "_above", "left").select(
            "_piece", F.col("_next").alias("_above"), (F.col("value") + F.coalesce("_more", F.lit(0.0))).alias("value"),
            F.col("_more").isNotNull().alias("_moved")))
        up = step.drop("_moved")
        if step.where("_moved").isEmpty():
            break
    return (values.where(digits).join(up.select(F.col("_piece").alias("_g"), F.col("value").alias("_more")), "_g", "left")
            .select(F.col("what").cast("long").alias("_n"), (F.col("value") + F.coalesce("_more", F.lit(0.0))).alias("value")))


def dwof(points: DataFrame, k: int, delta: float = 1.1, key: str = "Species", pid: str = "H3", lat: str = "LAT",
         lon: str = "LON", geomodel: str = "sphere", piece_edges: int = PIECE_EDGES) -> DataFrame:
    """Dynamic window outlier factor (D23, Momtaz et al. 2013); low scores are outliers.

    A point's window begins with the mean distance among its ``k`` nearest (see
    :func:`first_radii`) and grows by ``delta`` a step.  Points within the
    window of one of the two are in one component; at every step a point gains
    (size of its component before - 1) / (size now), until no point of the group
    is alone.  Groups in which no point has two neighbours score 0.
    """
    if k is None or isinstance(k, bool) or int(k) != k or k < 2:
        raise ValueError("the windows need two neighbours or more")
    if not delta > 1:
        raise ValueError("delta must be above 1")
    ship_package(points.sparkSession)
    measure = Meeting(geomodel, delta)
    numbered = _numbered(points, key, lat, lon, None)
    sites, pairs = first_radii(numbered, k, geomodel)
    sites = cut_lineage(sites.withColumn("_radius", F.when(F.col("_kth").isNull(), F.lit(_FAR)).otherwise(
        measure.step(F.col("_kth") / 1000.0, F.col("_span")))).drop("_kth"))
    own = sites.where("_core IS NOT NULL").select("_k", "_n", "_core")
    known = cut_lineage(
        keyed_join(keyed_join(pairs, own, ["_k", "_n"]),
                   own.select("_k", F.col("_n").alias("nid"), F.col("_core").alias("_o_core")), ["_k", "nid"])
        .select("_k", F.least("_n", "nid").alias("_a"), F.greatest("_n", "nid").alias("_b"),
                measure.weight(F.col("_dmm"), "_o_core").alias("_w")).distinct())
    sums = growth_sums(sites, spanning_edges(sites, known, measure), piece_edges)
    return (keyed_join(numbered, sums, "_n", "left").withColumn("OutlierScore", F.coalesce("value", F.lit(0.0)))
            .select(*points.columns, "OutlierScore"))
