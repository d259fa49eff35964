"""Near-duplicate vectors of one label: dual traversal of paged cover trees.

On unit vectors a cosine c is the distance sqrt(2 - 2c), a metric. Each label's
vectors are paged around pivots; two pages meet only if their covering radii
let them, and only those vectors travel that can reach the other page. A page's
task holds its cover tree and walks it against the trees of its guests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from canton.llm.graph import components, local_roots
from canton.session import stored_table as stored

SIMILARITY = 0.98
PAGE = 1_024  # vectors of a page, on average
PIVOTS = 64  # of a label
ALL_PIVOTS = 4_096  # broadcast; labels beyond have pages without a pivot, which are never pruned before they meet

_SLACK = 1e-6  # of distances computed from products
_POINT = 1e-5  # radius below which a node is not split: all its pairs are links


class CoverTree:
    """Nodes in breadth-first order; node i covers order[start[i]:stop[i]].

    The points of a node are split around a net of half the radius or less,
    which holds the node's own centre (nested) and whose points are farther
    apart than that. A level at which nothing would split is left out. Each
    node keeps the radius that it really covers.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        to_first = _distance(points, points[:1])[:, 0]
        rows = [(0, float(to_first.max(initial=0)), 0, len(points))]
        first, count = [], []
        at = 0
        while at < len(rows):
            centre, radius, start, stop = rows[at]
            at += 1
            first.append(len(rows))
            count.append(0)
            if stop - start > 1 and radius > _POINT:
                children = self._split(centre, 2.0 ** (math.ceil(math.log2(radius)) - 1), start, stop)
                rows += children
                count[-1] = len(children)
        self.centre, self.radius, self.start, self.stop = (np.array(c) for c in zip(*rows))
        self.first, self.count = np.array(first), np.array(count)

    def _split(self, centre: int, reach: float, start: int, stop: int) -> list[tuple]:
        members = self.order[start:stop].copy()
        x = self.points[members]
        owner, far = np.zeros(len(members), np.int64), np.zeros(len(members))
        free = np.ones(len(members), bool)
        net = [int(np.flatnonzero(members == centre)[0])]
        while True:
            d = _distance(x, x[net[-1] :][:1])[:, 0]
            near = free & (d <= reach)
            near[net[-1]] = True
            owner[near], far[near] = len(net) - 1, d[near]
            free &= ~near
            if not free.any():
                break
            net.append(int(free.argmax()))
        by = np.argsort(owner, kind="stable")
        self.order[start:stop] = members[by]
        edges = np.searchsorted(owner[by], np.arange(len(net) + 1))
        return [
            (int(members[c]), float(far[by][a:b].max()), start + int(a), start + int(b))
            for c, a, b in zip(net, edges, edges[1:])
        ]

    def below(self, node: int) -> np.ndarray:
        """The children of a node, or itself where it has none."""
        n = self.count[node]
        return np.arange(self.first[node], self.first[node] + n) if n else np.array([node])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class Links:
    """Per point of two trees: the weight of its links; and pairs that hold the links' components together."""

    def __init__(self, a: CoverTree, wa: np.ndarray, b: CoverTree, wb: np.ndarray):
        self.trees, self.weights = (a, b), (wa, wb)
        mine = np.zeros(len(wa), np.int64)
        self.counts = (mine, mine if a is b else np.zeros(len(wb), np.int64))
        self.ties: list[tuple[np.ndarray, np.ndarray]] = []

    def _members(self, side: int, node: int) -> np.ndarray:
        tree = self.trees[side]
        return tree.order[tree.start[node] : tree.stop[node]]

    def all(self, i: int, j: int) -> None:
        """Every point of node i is linked with every point of node j."""
        x, y = self._members(0, i), self._members(1, j)
        self.counts[0][x] += self.weights[1][y].sum()
        self.counts[1][y] += self.weights[0][x].sum()
        self.ties += [(x, np.full(len(x), y[0])), (np.full(len(y), x[0]), y)]

    def within(self, i: int) -> None:
        """All points of node i are linked with each other; both sides are the same tree."""
        x = self._members(0, i)
        self.counts[0][x] += self.weights[0][x].sum() - self.weights[0][x]
        self.ties.append((x, np.full(len(x), x[0])))

    def points(self, x: np.ndarray, y: np.ndarray) -> None:
        np.add.at(self.counts[0], x, self.weights[1][y])
        np.add.at(self.counts[1], y, self.weights[0][x])
        self.ties.append((x, y))


def dual_traversal(
    a: CoverTree, wa: np.ndarray, b: CoverTree, wb: np.ndarray, similarity: float
) -> tuple[Links, int]:
    """The exact links between two trees, or within one if both are the same object.

    A pair of nodes is dropped if no pair of their points can be near enough,
    and taken whole if all must be; else their children meet. Returns the links
    and the number of distances that were computed.
    """
    reach = math.sqrt(2 - 2 * similarity)
    same, out, computed = a is b, Links(a, wa, b, wb), 0
    stack = [(0, 0)]
    while stack:
        i, j = stack.pop()
        alone = same and i == j
        if alone and 2 * a.radius[i] + 2 * _SLACK <= reach:
            out.within(i)
            continue
        if alone and not a.count[i]:
            continue  # one point: a leaf of several is within the reach of any similarity below 1
        p, q = a.below(i), b.below(j)
        dots = a.points[a.centre[p]] @ b.points[b.centre[q]].T
        computed += dots.size
        d = np.sqrt(np.maximum(2 - 2 * dots, 0))
        cover = a.radius[p][:, None] + b.radius[q]
        open_ = d <= cover + reach + _SLACK
        if alone:
            open_ &= np.triu(np.ones(open_.shape, bool), 1)
            stack += [(int(c), int(c)) for c in p]
        point = cover == 0
        single = point & open_ & ((a.stop - a.start)[p][:, None] == 1) & ((b.stop - b.start)[q] == 1)
        x, y = np.nonzero(single & (dots >= similarity))
        if len(x):
            out.points(a.centre[p[x]], b.centre[q[y]])
        open_ &= ~single
        whole = open_ & (d + cover + _SLACK <= reach)
        for x, y in zip(*np.nonzero(whole)):
            out.all(int(p[x]), int(q[y]))
        for x, y in zip(*np.nonzero(open_ & ~whole)):
            m, n = int(p[x]), int(q[y])
            if a.count[m] or b.count[n]:
                stack.append((m, n))
                continue
            # Two points of many members each, too close to the bound: their members decide.
            u, v = a.order[a.start[m] : a.stop[m]], b.order[b.start[n] : b.stop[n]]
            s, t = np.nonzero(a.points[u] @ b.points[v].T >= similarity)
            out.points(u[s], v[t])
    return out, computed


_FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _found(nodes: np.ndarray, counts: np.ndarray, ties: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    some = np.flatnonzero(counts)
    x, y = (np.concatenate(c) for c in zip(*ties)) if ties else (some[:0], some[:0])
    root = local_roots(nodes, x, y)
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[some]), pa.array(counts[some]), pa.array(root[some])], schema=_FOUND
    )


def units(column: pa.Array) -> np.ndarray:
    """Unit vectors, in doubles, of complete vectors of one length that are not zero."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # Scaled by a power of two, squares neither overflow nor vanish.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _points(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    node, n = (part.column(c).to_numpy(zero_copy_only=False) for c in ("node", "n"))
    return node, n.astype(np.int64), units(part.column("x"))


def _meet(similarity: float):
    """Walk pages in a row: a page's own vectors first, then its guests in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, home = None, [], None

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal home
            if own:
                node, n, u = (np.concatenate(c) for c in zip(*own))
                own.clear()
                tree = CoverTree(u)
                home = (node, n, tree)
                links, _ = dual_traversal(tree, n, tree, n, similarity)
                yield _found(node, links.counts[0], links.ties)

        for batch in batches:
            key = batch.column("home").to_numpy(zero_copy_only=False)
            guest = batch.column("guest").to_numpy(zero_copy_only=False).astype(bool)
            edges = np.flatnonzero((key[1:] != key[:-1]) | (guest[1:] != guest[:-1])) + 1
            for start, stop in zip([0, *edges], [*edges, len(key)]):
                if start == stop:
                    continue
                if at != key[start]:
                    yield from settle()
                    at, home = key[start], None
                if not guest[start]:
                    own.append(_points(batch.slice(start, stop - start)))
                    continue
                yield from settle()
                for low in range(start, stop, PAGE):
                    node, n, u = _points(batch.slice(low, min(PAGE, stop - low)))
                    links, _ = dual_traversal(home[2], home[1], CoverTree(u), n, similarity)
                    base = len(home[0])
                    yield _found(
                        np.concatenate([home[0], node]),
                        np.concatenate(links.counts),
                        [(x, y + base) for x, y in links.ties],
                    )
        yield from settle()

    return run


def _place(pivots: dict[str, np.ndarray]):
    """Each vector's nearest pivot of its part and the distance to it; -1 and 0 without pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").to_pylist()
            pivot, far = np.full(len(parts), -1, np.int32), np.zeros(len(parts))
            for part in set(parts) & pivots.keys():
                rows = np.array([i for i, p in enumerate(parts) if p == part])
                d = _distance(units(batch.column("x").take(pa.array(rows))), pivots[part])
                pivot[rows], far[rows] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pivot), pa.array(far)], [*batch.schema.names, "pivot", "far"]
            )

    return run


def _within_reach(pivots: dict[str, np.ndarray], reach: float):
    """Drop the guests that no vector of the page they visit can be near enough to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, pivot = batch.column("part").to_pylist(), batch.column("pivot").to_pylist()
            radius = batch.column("radius").to_numpy(zero_copy_only=False)
            keep = np.ones(len(parts), bool)
            for part, p in set(zip(parts, pivot)):
                if p >= 0:
                    rows = np.array([i for i, at in enumerate(zip(parts, pivot)) if at == (part, p)])
                    d = _distance(units(batch.column("x").take(pa.array(rows))), pivots[part][p : p + 1])[:, 0]
                    keep[rows] = d <= radius[rows] + reach + _SLACK
            kept = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([kept.column(c) for c in ("home", "node", "n", "x")], ["home", "node", "n", "x"])

    return run


def _pivots(classes: DataFrame, large: DataFrame) -> dict[str, np.ndarray]:
    """At most PIVOTS vectors of each large part, ALL_PIVOTS in all, spread by a hash."""
    order = Window.partitionBy("part").orderBy(F.xxhash64("node"), "node")
    wanted = F.least(F.lit(PIVOTS), F.ceil(F.col("size") / PAGE))
    ranked = classes.join(large, "part").withColumn("rank", F.row_number().over(order))
    chosen = ranked.where((F.col("rank") <= PIVOTS) & (F.col("rank") <= wanted))
    found: dict[str, list] = {}
    for r in chosen.orderBy(F.desc("size"), "part", "rank").limit(ALL_PIVOTS).select("part", "x").collect():
        found.setdefault(r["part"], []).append(r["x"])
    return {part: units(pa.array(x, pa.list_(pa.float64()))) for part, x in found.items()}


def class_links(classes: DataFrame, similarity: float) -> DataFrame:
    """(node, links, root) of distinct vectors (node, n, part, x): partial counts, and ties that join components."""
    spark = classes.sparkSession
    reach = math.sqrt(2 - 2 * similarity)
    large = stored(
        classes.groupBy("part").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > PAGE), "large-parts"
    )
    pivots = _pivots(classes, large)
    kind = classes.schema["x"].dataType.simpleString()
    placed = stored(
        classes.mapInArrow(_place(pivots), f"node long, n long, part string, x {kind}, pivot int, far double"), "placed"
    )
    areas = stored(
        placed.join(large.select("part"), "part", "left_semi")
        .groupBy("part", "pivot")
        .agg(F.ceil(F.count(F.lit(1)) / PAGE).cast("int").alias("split"), F.max("far").alias("radius")),
        "areas",
    )
    page = F.concat_ws("|", "pivot", F.col("sub"), "part")
    sub = F.pmod(F.xxhash64(F.lit(7), "node"), F.coalesce("split", F.lit(1))).cast("int")
    paged = placed.join(areas.select("part", "pivot", "split"), ["part", "pivot"], "left")
    paged = paged.withColumn("sub", sub).withColumn("page", page)
    pages = areas.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("split") - 1))).withColumn("page", page)
    # The distances between a part's pivots: at most PIVOTS squared for each of the broadcast pivots' parts.
    gaps = [
        (part, i, j, float(d))
        for part, p in pivots.items()
        for i, row in enumerate(_distance(p, p))
        for j, d in enumerate(row)
    ]
    gaps = spark.createDataFrame(gaps, "part string, pivot int, other int, gap double")
    side = lambda s: pages.select(
        "part", F.col("page").alias(f"page_{s}"), F.col("pivot").alias(f"pivot_{s}"), F.col("radius").alias(f"radius_{s}")
    )
    near = areas.select("part", "pivot", F.col("radius").alias("radius_a")).join(
        areas.select("part", F.col("pivot").alias("other"), F.col("radius").alias("radius_b")), "part"
    )
    near = near.join(gaps, ["part", "pivot", "other"], "left").where(
        F.coalesce("gap", F.lit(0.0)) <= F.col("radius_a") + F.col("radius_b") + reach + 2 * _SLACK
    )
    met = (
        side("a")
        .join(near.select("part", F.col("pivot").alias("pivot_a"), F.col("other").alias("pivot_b")), ["part", "pivot_a"])
        .join(side("b"), ["part", "pivot_b"])
        .where(F.col("page_a") < F.col("page_b"))
    )
    # Which of the two travels is drawn by a hash, so that no page is home to all.
    first = F.pmod(F.xxhash64("page_a", "page_b"), F.lit(2)) == 0
    visits = met.select(
        F.when(first, F.col("page_a")).otherwise(F.col("page_b")).alias("home"),
        F.when(first, F.col("pivot_a")).otherwise(F.col("pivot_b")).alias("pivot"),
        F.when(first, F.col("radius_a")).otherwise(F.col("radius_b")).alias("radius"),
        F.when(first, F.col("page_b")).otherwise(F.col("page_a")).alias("page"),
    )
    guests = paged.select("page", "part", "node", "n", "x").join(visits, "page")
    guests = guests.select("home", "part", "pivot", "radius", "node", "n", "x").mapInArrow(
        _within_reach(pivots, reach), f"home string, node long, n long, x {kind}"
    )
    own = paged.select(F.col("page").alias("home"), F.lit(False).alias("guest"), "node", "n", "x")
    dealt = own.unionByName(guests.withColumn("guest", F.lit(True)))
    dealt = dealt.repartition("home").sortWithinPartitions("home", "guest")
    return dealt.mapInArrow(_meet(similarity), "node long, links long, root long")


def near_vectors(
    df: DataFrame,
    similarity: float = SIMILARITY,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id and kept: one row per row of ``df``.

    Two rows of one label are linked if the cosine of their vectors, in double
    precision, is ``similarity`` or more (above 0, below 1). ``n_links`` counts
    a row's links to other rows, ``component_id`` is the least id reached over
    links, and the row with that id is ``kept``. Links are exact.

    Rows with a NULL label or id, or whose vector is NULL, empty, all zeros or
    holds NULL or non-finite components, link with nothing; their component is
    their own id, and they are kept. Vectors of different lengths are not
    compared. Equal vectors take part once, with their number; rows of one id
    are rows of their own. Other columns are ignored, whatever their names; an
    empty table gives no rows.
    """
    x = F.col("x")
    rows = df.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("x")
    )
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) | ~F.exists(x, lambda e: e != 0)
    part = F.when(
        F.col("vec_id").isNotNull() & x.isNotNull() & ~bad & F.col("label").isNotNull(),
        F.concat_ws(":", F.size("x"), "label"),
    )
    rows = rows.select("vec_id", part.alias("part"), "x")
    rows = rows.withColumns({"h1": F.xxhash64("part", "x"), "h2": F.xxhash64(F.lit(1), "part", "x")})
    taking = rows.where(F.col("part").isNotNull())
    classes = stored(
        taking.groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min(F.struct("part", "x")).alias("one"))
        .select("h1", "h2", "rep", "n", "one.part", "one.x")
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    met = stored(class_links(classes.select("node", "n", "part", "x"), similarity), "links")
    roots = components(met.where(F.col("root") != F.col("node")).select(F.col("root").alias("u"), F.col("node").alias("v")))
    reps = roots.join(classes.select("node", "rep"), "node")
    least = reps.groupBy("root").agg(F.min("rep").alias("component"))
    found = (
        classes.select("h1", "h2", "node", "n", "rep")
        .join(met.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(roots.join(least, "root").select("node", "component"), "node", "left")
        .select(
            "h1", "h2",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    found = stored(found, "classes")
    linked = taking.select("vec_id", "h1", "h2").join(found, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("part").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return linked.unionByName(alone).withColumn("kept", kept)
