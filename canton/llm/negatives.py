"""Hard negatives by exact inner products from subset-sum tables (Four Russians).

Eight dimensions of an anchor make a table of its 256 subset sums. A candidate's
integers are cut into bit planes, eight dimensions a byte: the sum of a plane's
lookups is the anchor's product with that plane, and the planes are shifted and
added into the full score. Anchors in groups of bounded size meet all
candidates, which stand in chunks; nothing but best rows leaves a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from canton.llm.mtree import integer_vectors, matrix
from canton.session import stored_table as stored

BITS = 8  # dimensions of a table
GROUP = 65_536  # components of the anchors of a group, on average: 8 MB of tables
CHUNK = 4_096  # candidates that are scored at once
ROWS = 256  # of them, whose sums stay in the processor's cache
SLOT = 16 * CHUNK  # candidates of a slot: each group's anchors are sent once to each slot
POSITIVES = NEGATIVES = 5


def planes(vectors: np.ndarray) -> np.ndarray:
    """(planes, byte groups, rows) bytes of the two's complement of an int64 matrix.

    The last plane is the sign's; as many planes as the largest value needs.
    """
    low, high = int(vectors.min(initial=0)), int(vectors.max(initial=0))
    bits = max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1
    width = -(-vectors.shape[1] // BITS) * BITS
    padded = np.zeros((len(vectors), width), np.int64)
    padded[:, : vectors.shape[1]] = vectors
    return np.stack([np.packbits((padded >> p & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(bits)])


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(byte groups, 256, anchors): the sums of each anchor over each set of eight dimensions."""
    width = -(-anchors.shape[1] // BITS) * BITS
    padded = np.zeros((width, len(anchors)), anchors.dtype)
    padded[: anchors.shape[1]] = anchors.T
    tables = np.zeros((width // BITS, 1 << BITS, len(anchors)), anchors.dtype)
    for bit in range(BITS):  # the sets with this bit are those without it, plus one dimension
        half = 1 << bit
        tables[:, half : 2 * half] = tables[:, :half] + padded[bit::BITS][:, None, :]
    return tables


def scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(rows, anchors) exact products: one lookup per plane and eight dimensions."""
    total = np.zeros((packed.shape[2], tables.shape[2]), tables.dtype)
    last = len(packed) - 1
    for low in range(0, len(total), ROWS):
        sums = total[low : low + ROWS]
        for p in range(last, -1, -1):  # the highest plane is doubled most often, and negative
            sums += sums
            for table, row in zip(tables, packed[p, :, low : low + ROWS]):
                if p == last:
                    sums -= table[row]
                else:
                    sums += table[row]
    return total


def _clip(values: np.ndarray) -> np.ndarray:
    if values.dtype != object:
        return values
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([min(max(int(x), low), high) for x in values.ravel()], np.int64).reshape(values.shape)


class _Anchors:
    """The anchors of one group, by vector length, with tables made when first needed."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.tables: dict[tuple, tuple] = {}

    def of(self, length: int, most: float) -> tuple[list[tuple], np.ndarray]:
        """The anchors of a length and their tables, in integers that hold every sum with values up to ``most``."""
        if length not in self.tables:
            rows = [r for r in self.rows if len(r[3]) == length]
            v = np.array([r[3] for r in rows], np.int64).reshape(len(rows), length)
            self.tables[length] = (rows, v, float(np.abs(v.astype(float)).sum(axis=1).max(initial=0)), {})
        rows, v, sums, made = self.tables[length]
        bound = 2 * sums * (most + 1)
        kind = np.int32 if bound < 2**30 else np.int64 if bound < 2**62 else object
        if kind not in made:
            made[kind] = subset_sums(v.astype(kind))
        return rows, made[kind]

    def score(self, v: np.ndarray) -> Iterator[tuple[tuple, np.ndarray]]:
        """(anchor, its products with the rows of v) of every anchor of that length."""
        most = max(-float(v.min(initial=0)), float(v.max(initial=0)))
        rows, tables = self.of(v.shape[1], most)
        if rows and len(v):
            got = np.ascontiguousarray(_clip(scores(tables, planes(v))).T)
            yield from zip(rows, got)


_DEALT = "team int, slot int, row long, vec_id long, label long, v array<long>, bar array<struct<id:long,score:long>>"
_FOUND = "row long, no int, id long, score long"
_FOUND_SCHEMA = pa.schema([("row", pa.int64()), ("no", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def _meet(choose: Callable) -> Callable:
    """Walk sorted (group, slot) runs: first the anchors of a run, then its candidates.

    ``choose(anchor, scores, ids, labels)`` yields (no, row numbers): at most a
    few rows a chunk. They are merged per anchor before they leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, at, best = _Anchors(), None, {}

        def flush():
            if best:
                rows = [(row, no, i, s) for (row, no), list_ in best.items() for s, i in list_]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND_SCHEMA)], schema=_FOUND_SCHEMA
                )
                best.clear()

        for batch in batches:
            team, slot = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("team", "slot"))
            edges = np.flatnonzero((np.diff(team) != 0) | (np.diff(slot) != 0)) + 1
            for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
                if start == stop:
                    continue
                if at != (team[start], slot[start]):
                    yield from flush()
                    anchors, at = _Anchors(), (team[start], slot[start])
                part = batch.slice(start, stop - start)
                heads = len(part) - part.column("row").null_count
                for r in part.slice(0, heads).to_pylist():
                    anchors.rows.append((r["row"], r["vec_id"], r["label"], r["v"], r["bar"]))
                for low in range(heads, len(part), CHUNK):
                    chunk = part.slice(low, CHUNK)
                    ids, labels = (chunk.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                    for rows, v in matrix(chunk.column("v")):
                        for anchor, s in anchors.score(v):
                            for no, keep in choose(anchor, s, ids[rows], labels[rows]):
                                old = best.setdefault((anchor[0], no), [])
                                old += zip(s[keep].tolist(), ids[rows][keep].tolist())
                                old.sort(key=lambda x: (-x[0], x[1]))
                                del old[max(POSITIVES, NEGATIVES) :]
        yield from flush()

    return run


def _first(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The k first of ``rows`` by score, ties by the smaller id."""
    if len(rows) > 4 * k:
        bar = np.partition(score[rows], len(rows) - k)[len(rows) - k]
        rows = rows[score[rows] >= bar]
    return rows[np.lexsort((ids[rows], ~score[rows]))[:k]]


def _positives(anchor, s, ids, labels):
    rows = np.flatnonzero((labels == anchor[2]) & (ids != anchor[1]))
    if len(rows):
        yield 0, _first(s, ids, rows, POSITIVES)


def _negatives(anchor, s, ids, labels):
    # 80 top <= 100 score <= 100 top, in whole numbers: ceil(4 top / 5) <= score <= top.
    bars = [(-(-4 * p["score"] // 5), p["score"]) for p in anchor[4]]
    near = (s >= min(b[0] for b in bars)) & (s <= max(b[1] for b in bars))
    other = np.flatnonzero(near & (labels != anchor[2]))
    order = other[np.lexsort((ids[other], ~s[other]))]
    falling = ~s[order]
    for no, (least, top) in enumerate(bars):
        start, stop = np.searchsorted(falling, ~top, "left"), np.searchsorted(falling, ~least, "right")
        if start < stop:
            yield no, order[start : min(stop, start + NEGATIVES)]


def hard_negatives(
    df: DataFrame,
    query_every: int = 100,
    scale: int = 256,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows whose id is divisible by ``query_every``; their
    positives are the 5 best other rows of their label, and for each positive
    the 5 best rows of other labels are returned whose score is at most the
    positive's and at least 0.8 of it. A score is the inner product of the
    vectors floor(scale * x); ties go to the smaller id.

    Rows without an id, label or vector, or with NULL or non-finite components,
    take no part; a vector is compared with those of its length only. Rows of
    one id are rows of their own, but not positives of each other; repeated
    anchors are answered once a row. Scores outside 64 bits are clipped. Other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = df.sparkSession
    plain = df.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("x"), F.col(label).cast("long").alias("label")
    ).where(F.col("label").isNotNull())
    rows = stored(
        integer_vectors(plain.withColumn("x", F.col("x").cast("array<double>")), "vec_id", "x", scale, "label"),
        "candidates",
    )
    anchors = stored(
        rows.where(F.col("vec_id") % query_every == 0).withColumn("row", F.monotonically_increasing_id()), "anchors"
    )
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("most")).first()
    if not size["n"]:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    asked = anchors.count()
    teams = -(-asked * max(size["most"], 1) // GROUP)
    slots = -(-size["n"] // SLOT)
    # Each candidate goes once to each group of anchors, each anchor once to each slot.
    spread = F.pmod(F.xxhash64("vec_id", "v"), F.lit(slots)).cast("int")
    team = F.pmod(F.xxhash64("row"), F.lit(max(teams, 1))).cast("int")
    candidates = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(max(teams, 1) - 1))).alias("team"), spread.alias("slot"),
        F.lit(None).cast("long").alias("row"), "vec_id", "label", "v",
        F.lit(None).cast("array<struct<id:long,score:long>>").alias("bar"),
    )

    def found(heads: DataFrame, choose: Callable, k: int, *by: str) -> DataFrame:
        """The k best rows of each anchor (and positive) over all slots."""
        sent = heads.select(
            team.alias("team"), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
            "row", "vec_id", "label", "v", "bar",
        )
        dealt = sent.unionByName(candidates).repartition("team", "slot")
        dealt = dealt.sortWithinPartitions("team", "slot", F.col("row").isNull())
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
        ranked = dealt.mapInArrow(_meet(choose), _FOUND).withColumn("rank", F.row_number().over(order))
        return ranked.where(F.col("rank") <= k)

    none = F.lit(None).cast("array<struct<id:long,score:long>>")
    best = found(anchors.withColumn("bar", none), _positives, POSITIVES, "row")
    bars = best.groupBy("row").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "id", "score"))), lambda x: F.struct(x["id"], x["score"])
        ).alias("bar")
    )
    barred = stored(anchors.join(bars, "row"), "positives")
    negatives = found(barred, _negatives, NEGATIVES, "row", "no")
    bar = F.get("bar", F.col("no"))
    return negatives.join(barred.select("row", F.col("vec_id").alias("anchor_id"), "bar"), "row").select(
        "anchor_id",
        bar["id"].alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        bar["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def relabelled(df: DataFrame) -> DataFrame:
    """``df`` with the label of every seventh vec_id moved on by one, modulo ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return df.select("vec_id", "embedding", moved.alias("label"))
