"""Exact top-k inner products by best-first search in paged M-trees.

An inner product is no metric, so each candidate x gets one more coordinate,
sqrt(M - |x|^2) with M the largest squared norm, and each query a zero there:
squared distances are then |q|^2 + M - 2 q.x, and the nearest neighbours are
the highest products. Vectors are dealt to pages around pivots; each page of
bounded size holds one tree, whose entries store their covering radius and
their distance to the parent object. Every query block meets every page, and
the triangle inequality over the stored distances leaves out computations.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from canton.session import stored_table as stored

PAGE = 4_096  # vectors of a page, on average at most
PIVOTS = 64  # objects around which pages are formed
SEEDS = 1_024  # vectors whose products give each query its first bound
NODE = 32  # entries of a leaf
FANOUT = 16  # entries of an inner node
BLOCK = 128  # queries of a block
BUCKET_BITS = 12  # of the hash by which the seeds are found

_EXACT = 2.0**52  # sums below stay exact in doubles


def integer_vectors(df: DataFrame, id_column: str, vector: str, scale: int, *others: str) -> DataFrame:
    """vec_id, floor(scale * x) of each vector that takes part, and the ``others``."""
    x = F.col(vector)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return df.where(x.isNotNull() & ~bad & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double"))).alias("v"),
        *others,
    )


def matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and int64 matrix of the vectors of each length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    out = []
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out.append((rows, values[starts[rows][:, None] + np.arange(n)].astype(np.int64)))
    return out


def products(vectors: np.ndarray, queries: np.ndarray, exact: bool) -> np.ndarray:
    """(queries, vectors) integer inner products; beyond doubles in Python's integers."""
    if exact:
        return queries.astype(np.float64) @ vectors.astype(np.float64).T
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    whole = queries.astype(object) @ vectors.astype(object).T
    out = np.empty(whole.shape, object)
    out.flat = [min(max(x, low), high) for x in whole.flat]
    return out


class Tree:
    """One page. Entry arrays hold node after node; node n owns first[n]:first[n + 1]."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: float):
        self.ids, self.vectors, self.top = ids, vectors, top
        norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self._points = np.column_stack([vectors, np.sqrt(np.maximum(top - norms, 0))]).astype(float)
        nodes: list[tuple] = []
        # (members, parent object): children are numbered in the order they are queued.
        queue: list[tuple[np.ndarray, int]] = [(np.arange(len(ids)), -1)]
        at = 0
        while at < len(queue):
            members, parent = queue[at]
            at += 1
            if len(members) <= NODE:
                nodes.append((members, self._to(parent, members), np.zeros(len(members)), np.full(len(members), -1)))
                continue
            objects, groups = self._split(members)
            radii = np.array([self._to(o, g).max() for o, g in zip(objects, groups)])
            children = np.arange(len(queue), len(queue) + len(groups))
            queue += list(zip(groups, objects))
            nodes.append((np.array(objects), self._to(parent, np.array(objects)), radii, children))
        self.first = np.cumsum([0, *(len(n[0]) for n in nodes)]).astype(np.int32)
        self.object, self.parent, self.radius, self.child = (
            np.concatenate([n[k] for n in nodes]).astype(kind)
            for k, kind in enumerate((np.int32, np.float64, np.float64, np.int32))
        )
        del self._points

    def _to(self, parent: int, members: np.ndarray) -> np.ndarray:
        if parent < 0:
            return np.zeros(len(members))
        return np.sqrt(((self._points[members] - self._points[parent]) ** 2).sum(axis=1))

    def _split(self, members: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
        objects = members[np.linspace(0, len(members) - 1, FANOUT).astype(int)]
        far = np.column_stack([self._to(o, members) for o in objects])
        near = far.argmin(axis=1)
        found = np.unique(near)
        if len(found) == 1:  # equal vectors: any even split is as good
            groups = np.array_split(members, FANOUT)
            return [int(g[0]) for g in groups], groups
        return [int(objects[j]) for j in found], [members[near == j] for j in found]

    _COLUMNS = {
        "ids": np.int64, "vectors": np.int64, "first": np.int32, "object": np.int32,
        "parent": np.float64, "radius": np.float64, "child": np.int32,
    }

    def pages(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name)).tobytes() for name in self._COLUMNS}

    @classmethod
    def of(cls, row: dict[str, bytes], top: float) -> Tree:
        tree = cls.__new__(cls)
        for name, kind in cls._COLUMNS.items():
            setattr(tree, name, np.frombuffer(row[name], kind))
        tree.vectors = tree.vectors.reshape(len(tree.ids), -1)
        tree.top = top
        return tree

    def search(
        self, queries: np.ndarray, own: np.ndarray, k: int, bounds: np.ndarray
    ) -> list[list[tuple[int, int]]]:
        """Per query of a block, the k best (score, id) of this page that reach its bound.

        Nodes are visited best-first by the least lower bound over the block;
        a query takes part in a visit only while its own bound allows it.
        """
        q2 = (queries.astype(np.float64) ** 2).sum(axis=1)
        exact = max(float(q2.max(initial=0)), self.top) < _EXACT
        slack = 1e-6 * (1 + self.top**0.5 + q2**0.5)

        def far(score, i) -> np.ndarray:
            return np.sqrt(np.maximum(q2[i] + self.top - 2 * score, 0))

        best: list[list[tuple[int, int]]] = [[] for _ in own]
        everyone = np.arange(len(own))
        limit = np.where(np.isinf(bounds), np.inf, far(np.where(np.isinf(bounds), 0, bounds), everyone) + slack)
        # (least lower bound, node, queries, their lower bounds, their distances to the parent)
        heap: list[tuple] = [(0.0, 0, everyone, np.zeros(len(own)), None)]
        while heap:
            _, node, asked, lows, to_parent = heapq.heappop(heap)
            still = lows <= limit[asked]
            asked, lows = asked[still], lows[still]
            if not len(asked):
                continue
            e = np.arange(self.first[node], self.first[node + 1])
            if to_parent is not None:
                # No distance is computed for entries this rules out for all.
                gap = np.abs(to_parent[still][:, None] - self.parent[e]) - self.radius[e]
                open_to = gap <= limit[asked][:, None]
                some, who = open_to.any(axis=0), open_to.any(axis=1)
                e, asked, lows, open_to = e[some], asked[who], lows[who], open_to[np.ix_(who, some)]
                if not len(e):
                    continue
            else:
                open_to = np.ones((len(asked), len(e)), bool)
            scores = products(self.vectors[self.object[e]], queries[asked], exact)
            distance = far(scores.astype(np.float64), asked[:, None])
            if self.child[e[0]] < 0:
                ids = self.ids[self.object[e]]
                keep = open_to & (ids != own[asked][:, None]) & (distance <= limit[asked][:, None])
                for row in np.flatnonzero(keep.any(axis=1)):
                    i, new = asked[row], keep[row]
                    best[i] += zip(map(int, scores[row][new]), ids[new].tolist())
                    best[i].sort(key=lambda x: (-x[0], x[1]))
                    del best[i][k:]
                    if len(best[i]) == k:
                        limit[i] = min(limit[i], far(float(best[i][-1][0]), i) + slack[i])
                continue
            inner = np.maximum(distance - self.radius[e], lows[:, None])
            for n in range(len(e)):
                go = open_to[:, n] & (inner[:, n] <= limit[asked])
                if go.any():
                    low = inner[go, n]
                    heapq.heappush(
                        heap, (float(low.min()), int(self.child[e[n]]), asked[go], low, distance[go, n])
                    )
        return best


_TREE = "page int, " + ", ".join(f"{name} binary" for name in Tree._COLUMNS)


def exact_top_k(
    df: DataFrame,
    k: int = 10,
    query_every: int = 100,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of each query.

    Queries are the rows whose id is divisible by ``query_every``; candidates
    are all rows of the same vector length but those of the query's own id.
    Ties go to the smaller id. Vectors that are NULL or hold NULL or
    non-finite components, and rows without an id, take no part. A repeated id
    is a candidate per row; as a query it counts once, with its least vector.
    Scores outside 64 bits are clipped. An empty table gives no rows.
    """
    spark = df.sparkSession
    vectors = integer_vectors(df, id_column, vector, scale)
    square = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    spread = F.xxhash64("vec_id")
    bucket = F.shiftright(spread, 64 - BUCKET_BITS)
    # One row per bucket of the hash.
    counted = sorted(vectors.groupBy(bucket).agg(F.count(F.lit(1)), F.max(square)).collect())
    if not counted:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top = max(square for _, _, square in counted)
    filled = np.cumsum([n for _, n, _ in counted])
    last = counted[min(int(np.searchsorted(filled, SEEDS)), len(counted) - 1)][0]
    # Bounded: SEEDS rows, spread over the table by a hash. Collected from a table: a collected
    # limit sends the driver as many rows of every partition.
    seeds = stored(vectors.where(bucket <= last).orderBy(spread, "vec_id", "v").limit(SEEDS), "seeds").collect()
    seed_ids = np.array([r["vec_id"] for r in seeds])
    seed_v = {
        n: ([j for j, r in enumerate(seeds) if len(r["v"]) == n])
        for n in {len(r["v"]) for r in seeds}
    }
    seed_v = {n: (seed_ids[j], np.array([seeds[i]["v"] for i in j], np.int64).reshape(len(j), n)) for n, j in seed_v.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot = np.zeros(batch.num_rows, np.int32)
            for rows, v in matrix(batch.column("v")):
                n = v.shape[1]
                if n in seed_v and n:
                    p = seed_v[n][1][:PIVOTS].astype(np.float64)
                    x = v.astype(np.float64)
                    pivot[rows] = ((p**2).sum(axis=1) - 2 * (x @ p.T)).argmin(axis=1)
                pivot[rows] += n * PIVOTS
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(pivot)], ["vec_id", "v", "pivot"]
            )

    placed = vectors.mapInArrow(place, "vec_id long, v array<long>, pivot int")
    # One row per pivot and vector length.
    sizes = {r["pivot"]: r["count"] for r in placed.groupBy("pivot").count().collect()}
    base, pages = {}, 0
    for p in sorted(sizes):
        base[p] = (pages, -(-sizes[p] // PAGE))
        pages += base[p][1]
    start = F.create_map(*[F.lit(x) for p, (b, _) in base.items() for x in (p, b)])
    split = F.create_map(*[F.lit(x) for p, (_, s) in base.items() for x in (p, s)])
    paged = placed.select(
        (start[F.col("pivot")] + F.pmod(F.xxhash64("vec_id"), split[F.col("pivot")])).cast("int").alias("page"),
        "vec_id",
        "v",
    )

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ((_, v),) = matrix(group.column("v").chunk(0))
        order = np.argsort(group.column("vec_id").to_numpy(), kind="stable")
        tree = Tree(group.column("vec_id").to_numpy()[order], v[order], top)
        row = {"page": group.column("page").slice(0, 1).combine_chunks()}
        return pa.table(row | {n: pa.array([b], pa.binary()) for n, b in tree.pages().items()})

    trees = paged.groupBy("page").applyInArrow(build, _TREE)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            for rows, v in matrix(batch.column("v")):
                for at in range(0, len(rows), BLOCK):
                    own, q = ids[rows[at : at + BLOCK]], v[at : at + BLOCK]
                    bounds = np.full(len(own), -np.inf)
                    if v.shape[1] in seed_v:
                        sid, sv = seed_v[v.shape[1]]
                        exact = max(top, float((q.astype(float) ** 2).sum(axis=1).max())) < _EXACT
                        s = products(sv, q, exact).astype(np.float64)
                        s[own[:, None] == sid] = -np.inf
                        if s.shape[1] >= k:
                            bounds = np.sort(s, axis=1)[:, -k]
                    yield pa.RecordBatch.from_pydict(
                        {n: pa.array([x.tobytes()], pa.binary()) for n, x in (("own", own), ("q", q), ("bound", bounds))}
                    )

    queries = vectors.where(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = queries.mapInArrow(blocks, "own binary, q binary, bound binary").withColumn(
        "page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)))
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree.of(row, top)
                own = np.frombuffer(row["own"], np.int64)
                q = np.frombuffer(row["q"], np.int64).reshape(len(own), -1)
                if q.shape[1] != tree.vectors.shape[1]:
                    continue
                got = tree.search(q, own, k, np.frombuffer(row["bound"], np.float64))
                found = [(int(i), vec, score) for i, best in zip(own, got) for score, vec in best]
                columns = list(zip(*found)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
                )

    # Never broadcast: a block's rows are one per page, far more than their estimate by its vectors.
    found = asked.hint("merge").join(trees, "page").mapInArrow(answer, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
