"""HDBSCAN labels and GLOSH scores against literal top-down versions on records."""

from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest

from occuflow.operators import density, hierarchy, knn, scores

R = 6371008.8


def mm(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = (math.sin((q - p) / 2) ** 2
         + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)
    return math.floor(2 * R * math.asin(math.sqrt(min(1.0, h))) * 1000 + 0.5)


def reachability(records, k):
    """Mutual reachability of all pairs of records, and core distances (None if too few)."""
    n = len(records)
    d = [[mm(a, b) for b in records] for a in records]
    if n < k:
        return None, None
    core = [sorted(row)[k - 1] for row in d]
    return [[max(d[i][j], core[i], core[j]) for j in range(n)] for i in range(n)], core


def parts(members, w, below):
    """Components of ``members`` with edges shorter than ``below``."""
    left, out = set(members), []
    while left:
        todo = [left.pop()]
        part = set(todo)
        while todo:
            i = todo.pop()
            near = [j for j in left if w[i][j] < below]
            left.difference_update(near)
            part.update(near)
            todo += near
        out.append(part)
    return out


def unit(d):
    return 2 * 10 ** 18 if d == 0 else 10 ** 18 // d


def hdbscan(records, k, m):
    """Cluster of every record (None: noise), top-down from the whole group."""
    w, _ = reachability(records, k)
    if w is None:
        return [None] * len(records)
    clusters = []  # parent, birth, fallen {record: level}, [(child, level, size)]

    def grow(members, number):
        while True:
            levels = sorted({w[i][j] for i in members for j in members if i != j})
            if not levels:
                clusters[number]["fallen"].update(dict.fromkeys(members, w[min(members)][min(members)]))
                return
            low, high = 0, len(levels) - 1  # least level that joins all members
            while low < high:
                mid = (low + high) // 2
                if len(parts(members, w, levels[mid] + 1)) == 1:
                    high = mid
                else:
                    low = mid + 1
            at = levels[low]
            children = parts(members, w, at)
            big = [c for c in children if len(c) >= m]
            for c in children:
                if len(c) < m:
                    clusters[number]["fallen"].update(dict.fromkeys(c, at))
            if len(big) == 1:
                members = big[0]
                continue
            for c in big:
                clusters.append({"parent": number, "birth": at, "fallen": {}, "joined": []})
                clusters[number]["joined"].append((len(clusters) - 1, at, len(c)))
                grow(c, len(clusters) - 1)
            return

    clusters.append({"parent": None, "birth": None, "fallen": {}, "joined": []})
    if len(records) >= m:
        grow(set(range(len(records))), 0)
    chosen = {}

    def mass(number):
        c = clusters[number]
        birth = 0 if c["birth"] is None else unit(c["birth"])
        own = sum(unit(x) - birth for x in c["fallen"].values()) + sum((unit(x) - birth) * s for _, x, s in c["joined"])
        below = sum(mass(j) for j, _, _ in c["joined"])
        chosen[number] = c["parent"] is not None and own >= below
        return max(own, below)

    mass(0)
    out = [None] * len(records)
    for number, c in enumerate(clusters):
        top, at = None, number
        while at is not None:
            top = at if chosen[at] else top
            at = clusters[at]["parent"]
        for i in c["fallen"]:
            out[i] = top
    return out


def glosh(records, k):
    w, core = reachability(records, k)
    if w is None:
        return [0.0] * len(records)
    out = []
    for i, c in enumerate(core):
        same = next(p for p in parts(range(len(records)), w, c + 1) if i in p)
        out.append(1.0 - min(core[j] for j in same if core[j] <= c) / c if c else 0.0)
    return out


def sites(seed):
    """Groups with dense patches, chains, lone points, grid ties, the poles and repeated coordinates."""
    rng = random.Random(seed)
    rows = []
    for _ in range(40):
        rows.append(("a", rng.gauss(10, 0.3), rng.gauss(20, 0.3), 1))
        rows.append(("a", rng.gauss(12, 0.5), rng.gauss(23, 0.4), 1))
    for _ in range(15):
        rows.append(("a", rng.uniform(-90, 90), rng.uniform(-180, 180), 1))
    for i in range(8):
        for j in range(6):
            rows.append(("b", i * 0.25, j * 0.25, 1))
            rows.append((None, 89.5 - i * 0.05, (j * 60 - 180) / 1.0, 1 + (i * j) % 3))
    for i in range(30):
        rows.append(("c", 0.0, 179.9 + 0.01 * i if i < 10 else -180 + 0.01 * i, 1))
    rows += [("c", 40.0, 40.0, 7), ("c", 40.0, 40.001, 1), ("c", 41.0, 40.0, 5), ("d", 1.0, 1.0, 1), ("d", 2.0, 2.0, 1),
             ("e", 3.0, 3.0, 9), ("f", 3.0, 3.0, 6), ("f", 3.5, 3.0, 6), ("f", 9.0, 3.0, 1)]
    return [(s, f"p{i:04d}", la, lo, w) for i, (s, la, lo, w) in enumerate(rows)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(sites(5), "Species string, H3 string, LAT double, LON double, w long").repartition(3)


def by_group(rows):
    out = {}
    for s, i, la, lo, w in rows:
        out.setdefault(s, []).extend([(la, lo, i)] * w)
    return out


@pytest.fixture(scope="module")
def tree(spark, frame):
    """Numbered points, their core distances (k = 3) and the spanning tree; every search goes down to the leaves."""
    pairs, hierarchy.LEAF_PAIRS = hierarchy.LEAF_PAIRS, 0
    try:
        return hierarchy._hierarchy(frame, 3, "Species", "LAT", "LON", "sphere", "w")
    finally:
        hierarchy.LEAF_PAIRS = pairs


def check_labels(got, k, m):
    """``got``: {id: any name of its cluster}."""
    for s, records in by_group(sites(5)).items():
        label = hdbscan(records, k, m)
        mine, theirs = {}, {}
        for r, c in zip(records, label):
            mine.setdefault(got.get(r[2]), set()).add(r[2])
            theirs.setdefault(c, set()).add(r[2])
        assert mine.pop(None, set()) == theirs.pop(None, set()), s
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values())), s


@pytest.mark.parametrize("m,limit", [(5, 200_000), (5, 12)])
def test_condensed_tree_in_pieces(tree, m, limit):
    numbered, points, edges = tree
    member = hierarchy.condensed_clusters(points, edges, m, limit)
    rows = numbered.select("_n", "H3").join(member, "_n").collect()
    assert len(rows) == len({r["H3"] for r in rows})
    check_labels({r["H3"]: r["top"] for r in rows}, 3, m)


def test_hdbscan_labels(frame):
    rows = hierarchy.hdbscan_labels(frame, 4, 5, weight="w").collect()
    assert len(rows) == len(sites(5))
    check_labels({r["H3"]: r["cluster_rep"] for r in rows if r["cluster_rep"]}, 4, 5)
    least = {}
    for r in rows:
        assert (r["cluster"] == -1) == (r["cluster_rep"] is None)
        least[r["cluster_rep"]] = min(least.get(r["cluster_rep"], r["H3"]), r["H3"])
    assert all(k is None or k == v for k, v in least.items())


@pytest.mark.parametrize("limit", [200_000, 8])
def test_glosh_scores(tree, limit):
    numbered, points, edges = tree
    low = {r["_n"]: r["_low"] for r in hierarchy.least_cores(points, edges, limit).collect()}
    at = {r["H3"]: r["_n"] for r in numbered.select("H3", "_n").collect()}
    core = {r["_n"]: r["_core"] for r in points.collect()}
    for _, records in by_group(sites(5)).items():
        for r, s in zip(records, glosh(records, 3)):
            n = at[r[2]]
            got = 1.0 - low[n] / core[n] if core[n] and n in low else 0.0
            assert math.isclose(got, s, abs_tol=1e-12)


def test_spanning_tree_is_least(tree):
    numbered, _, edges = tree
    where = {r["_n"]: r["Species"] for r in numbered.collect()}
    rows = edges.collect()
    for s, records in by_group(sites(5)).items():
        w, _ = reachability(records, 3)
        if w is None:
            continue
        spots = sorted({r[2]: i for i, r in enumerate(records)}.values())
        inside, total = {spots[0]}, []
        while len(inside) < len(spots):
            edge, j = min((w[i][j], j) for i in inside for j in spots if j not in inside)
            inside.add(j)
            total.append(edge)
        # equally long edges may close rings: a forest of the edges taken in order is what counts
        up, taken = {i: i for r in rows for i in (r["_a"], r["_b"])}, []
        for w_, a, b in sorted((r["_w"], r["_a"], r["_b"]) for r in rows if where[r["_a"]] == s):
            while up[a] != a:
                a = up[a]
            while up[b] != b:
                b = up[b]
            if a != b:
                up[a] = b
                taken.append(w_)
        assert taken == sorted(total)


def windows(records, k, delta):
    """DWOF by literally growing the windows of all records."""
    n = len(records)
    d = [[mm(a, b) for b in records] for a in records]
    mean, near = [], []
    for i in range(n):
        order = sorted((d[i][j], j) for j in range(n) if j != i)
        hood = [j for x, j in order if len(order) < k or x <= order[k - 1][0]]
        pairs = [d[a][b] for a in hood for b in hood if a < b]
        mean.append(sum(pairs) / len(pairs) / 1000.0 if pairs else None)
        near += [x for x in pairs if x > 0]
    out = [0.0] * n
    if any(x is None for x in mean):
        return out
    unit_m = min(near) / 1000.0 if near else None
    radius = [1.0 if unit_m is None else x * unit_m / min(mean) if min(mean) > 0 else unit_m for x in mean]
    size, t = [1] * n, 0
    while True:
        t += 1
        grown = [r * delta ** t * (1 + 1e-12) for r in radius]
        now, left = [0] * n, set(range(n))
        while left:
            todo = [left.pop()]
            part = set(todo)
            while todo:
                i = todo.pop()
                hit = [j for j in left if d[i][j] / 1000.0 <= max(grown[i], grown[j])]
                left.difference_update(hit)
                part.update(hit)
                todo += hit
            for i in part:
                now[i] = len(part)
        out = [x + (a - 1) / b for x, a, b in zip(out, size, now)]
        size = now
        if 1 not in size:
            return out


def test_growing_windows(spark):
    rows = [(s, i, la, lo) for s, i, la, lo, _ in sites(6) if s in ("a", "c", "d", "f")] + [("g", "g1", 5.0, 5.0)]
    rows += [("h", f"h{i}", 5.0, 5.0) for i in range(4)]
    points = spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double").repartition(3)
    got = {r["H3"]: r["OutlierScore"] for r in hierarchy.dwof(points, 3).collect()}
    groups = {}
    for s, i, la, lo in rows:
        groups.setdefault(s, []).append((la, lo, i))
    assert len(got) == len(rows)
    for s, records in groups.items():
        for r, x in zip(records, windows(records, 3, 1.1)):
            assert math.isclose(got[r[2]], x, rel_tol=1e-9, abs_tol=1e-9), (s, r)


@pytest.mark.parametrize("limit", [7, 1000])
def test_growth_sums_in_pieces(spark, limit):
    """A path of meeting steps with ties, walked whole, in pieces, and in pieces of equal steps."""
    rng = random.Random(9)
    steps = [rng.choice([1, 1, 1, 2, 3, 5, 8, 8, 9]) for _ in range(60)]
    tree = spark.createDataFrame([("=a", w, i, i + 1) for i, w in enumerate(steps)], "_k string, _w long, _a long, _b long")
    points = spark.createDataFrame([("=a", i, 1.0) for i in range(61)], "_k string, _n long, _core double")
    got = {r["_n"]: r["value"] for r in hierarchy.growth_sums(points, tree, limit).collect()}
    ends = [min(([steps[i - 1]] if i else []) + ([steps[i]] if i < 60 else [])) for i in range(61)]
    size, want = [1] * 61, [0.0] * 61
    for t in range(1, max(ends) + 1):
        part = [0]
        for w in steps:
            part.append(part[-1] + (w > t))
        now = [part.count(p) for p in part]
        want = [x + (a - 1) / b for x, a, b in zip(want, size, now)]
        size = now
    assert len(got) == 61
    assert all(math.isclose(got[i], want[i], rel_tol=1e-12, abs_tol=1e-12) for i in range(61))


def test_removal_by_hdbscan_keeps_every_record(spark, frame):
    from pyspark.sql import functions as F

    records = (frame.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("w"))))
               .select("Species", "H3", F.col("LAT").alias("decimallatitude"), F.col("LON").alias("decimallongitude")))
    records = records.unionByName(spark.createDataFrame(
        [("a", "none", None, 1.0)], "Species string, H3 string, decimallatitude double, decimallongitude double"))
    kept, gone = density.remove_by_clustering(records, None, 3, method="HDBSCAN", by="Species", min_cluster_size=5)
    want_gone = {"none"}
    for s, rows in by_group(sites(5)).items():
        want_gone |= {r[2] for r, c in zip(rows, hdbscan(rows, 3, 5)) if c is None}
    assert {r["H3"] for r in gone.collect()} == want_gone
    assert kept.count() + gone.count() == records.count() and kept.columns == gone.columns == records.columns


def test_parameters_and_dispatcher(spark, frame):
    with pytest.raises(ValueError):
        hierarchy.hdbscan_labels(frame, 0, 5)
    with pytest.raises(ValueError):
        hierarchy.hdbscan_labels(frame, 3, 1)
    with pytest.raises(ValueError):
        hierarchy.dwof(frame, 1)
    with pytest.raises(ValueError):
        hierarchy.dwof(frame, 3, delta=1.0)
    assert not {"GLOSH", "DWOF"} & set(scores.NOT_BUILT)


def test_empty(spark, frame):
    none = frame.limit(0)
    assert hierarchy.hdbscan_labels(none, 3, 5).collect() == []
    assert hierarchy.glosh(none, 3).collect() == []


def worth(rows):
    """{cluster: topmost chosen cluster at or above it} by plain recursion over (cluster, parent, stability)."""
    below, value, chosen = {c: 0 for c, _, _ in rows}, {}, {}
    depth, up = {}, {c: p for c, p, _ in rows}
    for c in up:
        d, p = 0, c
        while up[p] is not None:
            d, p = d + 1, up[p]
        depth[c] = d
    for c, p, s in sorted(rows, key=lambda r: -depth[r[0]]):
        value[c], chosen[c] = max(s, below[c]), p is not None and s >= below[c]
        if p is not None:
            below[p] += value[c]
    top = {}
    for c in up:
        at, best = c, None
        while at is not None:
            best, at = at if chosen[at] else best, up[at]
        top[c] = best
    return top


@pytest.mark.parametrize("shape", ["chain", "random"])
def test_chosen_clusters_of_deep_trees(spark, monkeypatch, shape):
    """Rounds grow with the logarithm of the tree: a chain of 150 joins needs few stages."""
    r = random.Random(3)
    rows = [("r", None, 5)]
    if shape == "chain":  # a large cluster that takes in a small one at a time
        for i in range(150):
            rows.append((f"m{i}", f"m{i - 1}" if i else "r", r.randrange(60)))
            rows.append((f"s{i}", f"m{i - 1}" if i else "r", r.randrange(12)))
    else:
        for i in range(200):
            rows.append((f"n{i}", r.choice(rows[-12:])[0], r.randrange(40)))
    stages = []
    write = hierarchy.cut_lineage
    monkeypatch.setattr(hierarchy, "cut_lineage", lambda df, **o: stages.append(1) or write(df, **o))
    frame = spark.createDataFrame([(c, p, Decimal(s)) for c, p, s in rows],
                                  "cluster string, parent string, stability decimal(38,0)")
    got = {x["cluster"]: x["top"] for x in hierarchy._chosen(frame).collect()}
    assert got == worth(rows)
    assert len(stages) < 60


def test_point_tables_are_not_sent_through_the_driver(spark, frame, monkeypatch):
    """Tables that grow with the points are shuffled however small their files are."""
    plans = []

    def noted(df, **o):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, **o)

    write = hierarchy.cut_lineage
    for module in (hierarchy, knn, density):
        monkeypatch.setattr(module, "cut_lineage", noted)
    numbered = hierarchy._numbered(frame, "Species", "LAT", "LON", None)
    points, known = hierarchy.core_distances(numbered, 3, "sphere")
    density.connected_components(known.select("_k", known["_a"].alias("src"), known["_b"].alias("dst")))
    assert len(plans) > 6 and not [p for p in plans if "Broadcast" in p]
