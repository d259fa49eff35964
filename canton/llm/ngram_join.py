"""Near-duplicate join on word n-grams: MinHash banding, then exact verification.

Texts with equal n-gram sets form one class and take part once. Classes that
agree in a band are candidates. The candidates' connected groups meet by text:
each text of a group is shuffled once per block it meets, never once per pair,
and blocks of bounded size verify the Jaccard similarity on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from canton.llm.arrays import mix, shingle_sets, slices
from canton.llm.graph import components, local_roots
from canton.session import stored_table as stored

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999  # of pairs exactly at the similarity; others are found more surely
MAX_HASHES = 96
BLOCK = 64  # texts of a block
_COLUMNS = 8_192  # n-grams of a dense slice


def choose_bands(similarity: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most selective banding that reaches ``recall``.

    A pair agrees in some band with probability 1 - (1 - s**rows)**bands. The
    most rows whose necessary bands stay within ``max_hashes`` hashes are
    taken; one row per band is the fallback.
    """
    best = (max(1, math.ceil(math.log(1 - recall) / math.log1p(-similarity))), 1)
    for rows in range(2, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(similarity**rows)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.arange(1, n + 1, dtype=np.uint64)
    return mix(i * np.uint64(0xD6E8FEB86659FD93)), mix(i * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def band_hashes(values: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) hashes; the band number is part of each hash."""
    starts, full = offsets[:-1], np.diff(offsets) > 0
    seeds, odds = _constants(bands * rows)
    out = np.zeros((len(starts), bands), np.uint64)
    if not full.any():
        return out
    segments = starts[full]
    for band in range(bands):
        key = np.full(len(segments), band + 1, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            least = np.minimum.reduceat((values ^ seeds[k]) * odds[k], segments)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
        out[full, band] = key
    return out


def _digests(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share: two sums of independently mixed members."""
    sums = []
    for seed in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ np.uint64(seed)), out=total[1:])
        sums.append(total[offsets[1:]] - total[offsets[:-1]])
    return sums[0], sums[1]


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """The row key (id, t), the set digest (d1, d2, n) and the band hashes of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values, offsets = shingle_sets(part.column("text"), words)
            d1, d2 = _digests(values, offsets)
            n = np.diff(offsets)
            keys = band_hashes(values, offsets, bands, rows)
            full = n > 0
            ends = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("t"),
                    pa.array(d1.view(np.int64)),
                    pa.array(d2.view(np.int64)),
                    pa.array(n.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[full].ravel().view(np.int64))),
                ],
                ["id", "t", "d1", "d2", "n", "bands"],
            )

    return docs.mapInArrow(run, "id long, t long, d1 long, d2 long, n int, bands array<long>")


def shared_counts(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Matrix of the intersection sizes of the sets values[offsets[i]:offsets[i + 1]]."""
    sets = len(offsets) - 1
    member = np.repeat(np.arange(sets), np.diff(offsets))
    known, at, times = np.unique(values, return_inverse=True, return_counts=True)
    out = np.zeros((sets, sets))
    out[np.arange(sets), np.arange(sets)] = np.diff(offsets)
    # Only n-grams of two sets or more tell sets apart.
    number = np.cumsum(times > 1) - 1
    kept = times[at] > 1
    member, column = member[kept], number[at[kept]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    width = int(number[-1]) + 1 if len(known) else 0
    own = np.zeros(sets)
    for low in range(0, width, _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        dense = np.zeros((sets, min(_COLUMNS, width - low)), np.float32)
        dense[member[a:b], column[a:b] - low] = 1
        out += dense @ dense.T
        own += dense.sum(axis=1)
    out[np.arange(sets), np.arange(sets)] -= own
    return out


_MET = "node long, links long, root long"
_LAST = (1 << 63) - 1  # stands for a NULL doc_id: such rows come last


def keyed(docs: DataFrame) -> DataFrame:
    """The texts with their row keys: a doc_id alone does not tell rows apart, nor does NULL."""
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"),
        F.xxhash64(text).alias("t"),
        text.alias("text"),
    )


def linked_rows(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    max_hashes: int = MAX_HASHES,
) -> DataFrame:
    """(id, t, class_id, n_links, n_copies, first) of every row: ``first`` is the row (id, t) its group keeps."""
    bands, rows = choose_bands(similarity, recall, max_hashes)
    docs = keyed(docs)
    signed = stored(signatures(docs, words, bands, rows), "signatures")
    classes = stored(
        signed.groupBy("d1", "d2", "n")
        .agg(
            F.min(F.struct("id", "t")).alias("rep"),
            F.count(F.lit(1)).alias("n_copies"),
            F.any_value("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    keys = classes.where("n > 0").select("node", F.explode("bands").alias("band"))
    buckets = stored(
        keys.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most"),
        "buckets",
    )
    star = keys.join(buckets, "band").where(F.col("node") != F.col("least"))
    groups = components(star.select(F.col("least").alias("u"), F.col("node").alias("v")))
    sizes = stored(
        groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "groups"
    )
    # A text of block i meets the blocks j of its group in the pairs (i, j) and (j, i).
    placed = (
        groups.join(sizes, "root")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .join(classes.select("node", "rep", "n_copies", "d1", "d2"), "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "rep.id", "rep.t", "node", "d1", "d2", "root", "n_copies", "block",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        )
    )
    meeting = docs.join(placed, ["id", "t"])

    def verify(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        column = lambda n: group.column(n).to_numpy()
        node, copy, block = column("node"), column("n_copies"), column("block")
        text = group.column("text")
        text = text.chunk(0) if text.num_chunks else pa.array([], pa.string())
        values, offsets = shingle_sets(text, words)
        # Repeated rows are one member; a row that only shares its key with a member is none.
        d1, d2 = _digests(values, offsets)
        own = np.flatnonzero((d1.view(np.int64) == column("d1")) & (d2.view(np.int64) == column("d2")))
        keep = np.sort(own[np.unique(node[own], return_index=True)[1]])
        if len(keep) < len(node):
            values = np.concatenate([values[:0], *(values[offsets[i] : offsets[i + 1]] for i in keep)])
            offsets = np.concatenate([[0], np.cumsum(np.diff(offsets)[keep])])
            node, copy, block = node[keep], copy[keep], block[keep]
        n = np.diff(offsets).astype(np.float64)
        shared = shared_counts(values, offsets)
        union = n[:, None] + n[None, :] - shared
        linked = (shared >= similarity * union - 1e-9) & (node[:, None] != node[None, :])
        if group.column("low")[0].as_py() != group.column("high")[0].as_py():
            linked &= block[:, None] != block[None, :]  # pairs of one block meet elsewhere
        links = (linked * copy[None, :]).sum(axis=1)
        a, b = np.nonzero(np.triu(linked, 1))
        root = local_roots(node, a, b)
        kept = links > 0
        return pa.table(
            {"node": pa.array(node[kept]), "links": pa.array(links[kept].astype(np.int64)), "root": pa.array(root[kept])}
        )

    met = stored(meeting.groupBy("root", "low", "high").applyInArrow(verify, _MET), "links")
    linked = components(met.where(F.col("root") != F.col("node")).select(F.col("root").alias("u"), F.col("node").alias("v")))
    least = linked.join(classes.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("first"))
    firsts = linked.join(least, "root").select("node", "first")
    found = stored(
        met.groupBy("node").agg(F.sum("links").alias("links")).join(firsts, "node", "left"), "found"
    )
    placed_classes = classes.select("d1", "d2", "n", "node", "rep", "n_copies").join(found, "node", "left")
    result = signed.select("id", "t", "d1", "d2", "n").join(placed_classes, ["d1", "d2", "n"])
    first = F.coalesce("first", "rep")
    return result.select(
        "id", "t",
        F.when(first["id"] != _LAST, first["id"]).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("n_copies") - 1).alias("n_links"),
        "n_copies",
        first.alias("first"),
    )


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links and n_copies of every document.

    Two rows are linked if the Jaccard similarity of their sets of ``words``
    consecutive words (split at white space) is ``similarity`` or more.
    ``n_links`` counts a row's links to other rows, ``n_copies`` the rows with
    its own set, itself included; ``class_id`` is the least doc_id reached over
    links. A text with fewer words has the one n-gram of all its words; texts
    without words (empty, NULL) are copies of each other and of nothing else.
    Repeated rows count as copies; unlike texts of one doc_id are rows of their
    own; a class of rows without a doc_id has class NULL. Columns besides
    doc_id and text are ignored; an empty table gives no rows. Pairs at the
    similarity itself are found with probability ``recall``, more similar ones
    more surely; all that is reported is exact.
    """
    rows = linked_rows(docs, **options)
    return rows.select(F.when(F.col("id") != _LAST, F.col("id")).alias("doc_id"), "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without all but one row of each near-duplicate class.

    The row with the least doc_id stays, one without an id only where no row of
    the class has one; of unlike texts of one doc_id the one with the least
    hash counts. Of rows repeated with their doc_id and text one stays. All
    columns pass through; NULL and empty texts are one class.
    """
    rows = stored(linked_rows(docs, **options).select("id", "t", "first"), "rows")
    row = F.struct("id", "t")
    gone = rows.where(row != F.col("first")).select("id", "t").distinct()
    again = rows.where(row == F.col("first")).groupBy("id", "t").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = stored(again.select("id", "t"), "again")
    # The caller's columns travel as one, so that none can clash.
    whole = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("t"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    left_out = stored(gone.unionByName(again), "gone")
    kept = whole.join(left_out, ["id", "t"], "left_anti")
    once = whole.join(again, ["id", "t"]).dropDuplicates(["id", "t"])
    return kept.unionByName(once).select("row.*")
