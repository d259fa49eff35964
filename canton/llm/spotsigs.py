"""SpotSigs document fingerprints and their comparison.

A spot is an occurrence of an anchor, a very common word. Its signature is the
anchor with the chain of the next content words. The set of a text's
signatures is its fingerprint: boilerplate without running prose adds little,
and shared prose survives edits elsewhere.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from canton.llm.arrays import SLICE_BYTES, mix, prefix_hash, slices, span_hash, utf8

CHAIN = 2  # content words of a signature

#: Common words that serve as anchors and are no content words.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au aux dans de des du en est et la le les par pour que sur un une "
    "auf das dem den der des die ein eine im ist mit nicht und von zu "
    "al como con del el es las los no por se su una y"
).split()

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@functools.cache
def _anchor_hashes() -> np.ndarray:
    column = pa.array(ANCHORS, pa.string())
    raw, offsets = utf8(column)
    return np.unique(span_hash(prefix_hash(raw), offsets[:-1], offsets[1:]))


def spot_sets(column: pa.Array) -> list[np.ndarray]:
    """Ascending distinct 32-bit signatures of each text.

    The start of a text counts as an anchor too, so that every text with a
    content word has a signature. In a text without anchors (a table, a list,
    another language) every content word begins a chain. A text without
    content words has the one signature of its bytes, and the empty text none.
    """
    raw, offsets = utf8(column)
    texts = len(offsets) - 1
    raw = _LOWER[raw]
    solid = np.zeros(len(raw) + 1, bool)
    solid[:-1] = _WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:]
    starts = np.flatnonzero(begins)
    stops = ~solid
    stops |= edge
    ends = np.flatnonzero(stops[1:] & solid[:-1]) + 1
    prefix = prefix_hash(raw)
    hashes = span_hash(prefix, starts, ends)
    text = np.searchsorted(offsets, starts, side="right") - 1
    known = _anchor_hashes()
    anchor = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes
    content = np.flatnonzero(~anchor)
    content_text = text[content]
    # Spots: the starts of texts, the anchors, then the words of texts without anchors.
    spots = np.flatnonzero(anchor)
    bare = np.ones(texts, bool)
    bare[text[spots]] = False
    alone = content[bare[content_text]]
    owner = np.concatenate([np.arange(texts), text[spots], text[alone]])
    value = np.concatenate([np.zeros(texts, np.uint64), hashes[spots], np.zeros(len(alone), np.uint64)])
    after = np.concatenate([np.searchsorted(text, np.arange(texts)), spots, alone])
    chain = np.searchsorted(content, after)
    found = np.zeros(len(owner), bool)
    for k in range(CHAIN):
        at = chain + k
        inside = at < len(content)
        inside[inside] = content_text[at[inside]] == owner[inside]
        part = np.zeros(len(owner), np.uint64)
        part[inside] = hashes[content[at[inside]]]
        found |= inside
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + part)
    owner, value = owner[found], value[found]
    value = (value >> np.uint64(32)).astype(np.int64)
    key = np.unique((owner << 32) | value)
    owner, value = key >> 32, key & 0xFFFFFFFF
    bounds = np.searchsorted(owner, np.arange(texts + 1))
    whole = span_hash(prefix, offsets[:-1], offsets[1:]) >> np.uint64(32)
    return [
        value[bounds[i] : bounds[i + 1]]
        if bounds[i] < bounds[i + 1]
        else whole[i : i + int(offsets[i] < offsets[i + 1])].astype(np.int64)
        for i in range(texts)
    ]


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity; two empty sets are alike.

    The lengths bound it from above: pairs that cannot reach ``least`` get 0
    without a comparison, as do pairs whose ranges of signatures do not meet.
    """
    low, high = sorted((len(a), len(b)))
    if high == 0:
        return 1.0
    if low == 0 or low < least * high or a[-1] < b[0] or b[-1] < a[0]:
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    value = shared / (low + high - shared)
    return value if value >= least else 0.0


def told(signatures: np.ndarray) -> str:
    """The fingerprint as text: eight hexadecimal digits per signature."""
    return signatures.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``signatures``, the ascending signature set of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = pa.array(spot_sets(part.column("text")), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], ["doc_id", "signatures"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, signatures array<long>")


def near_pairs(sets: DataFrame, least: float = 0.8) -> DataFrame:
    """Pairs of set representatives with Jaccard similarity of ``least`` or more.

    Equal sets are one class, represented by its smallest doc_id (join the
    fingerprints to members by ``signatures``). Lengths are cut into ranges
    whose bounds grow by 1 / least: a set meets only sets of its own and of the
    next range, on the signatures of its prefix, and candidates are verified.
    Empty sets are left out.
    """
    classes = (
        sets.where(F.size("signatures") > 0)
        .groupBy("signatures")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("n", F.size("signatures"))
        .withColumn("band", F.floor(F.log(F.col("n").cast("double")) / -math.log(least) + 1e-9))
        .withColumn("prefix", F.slice("signatures", 1, F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1))
    )
    small = classes.select(
        F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("signatures").alias("s_a"),
        F.explode(F.array("band", F.col("band") + 1)).alias("band"), "prefix",
    ).withColumn("spot", F.explode("prefix")).drop("prefix")
    large = classes.select(
        F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("signatures").alias("s_b"),
        "band", F.explode("prefix").alias("spot"),
    )
    shared = F.size(F.array_intersect("s_a", "s_b"))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    return (
        small.join(large, ["band", "spot"])
        .where(ordered & (F.col("n_a") >= F.col("n_b") * least - 1e-9))
        .withColumn("likeness", shared / (F.col("n_a") + F.col("n_b") - shared))
        .where(F.col("likeness") >= least)
        .select("a", "b", "likeness")
        .distinct()
    )


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has the last half of its code points replaced by as many
    first ones of the next document in ascending doc_id; the last is followed
    by the first. Documents are dealt into id ranges that start at existing
    ids, each range also receives the head of the following one, and sorted
    ranges stream through the tasks: one shuffle of the texts. NULL text is
    empty. Rows without doc_id come before all others, and rows of one doc_id
    are ordered by text. Columns besides doc_id and text are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [n / ranges for n in range(1, ranges)]
    known = docs.agg(
        F.min("doc_id").alias("least"),
        F.max(F.col("doc_id").isNull()).alias("unknown"),
        F.percentile_approx("doc_id", cuts, 20 * ranges).alias("heads"),
    ).first()
    first = None if known["unknown"] else known["least"]
    # Bounded: one existing id per range.
    heads = sorted({h for h in known["heads"] or [] if known["unknown"] or h > known["least"]})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows, ranges_of, guests = [], [], []
            for i, x in enumerate(ids):
                at = 0 if x is None else bisect.bisect_right(heads, x)
                rows.append(i), ranges_of.append(at), guests.append(0)
                if at and x == heads[at - 1]:
                    rows.append(i), ranges_of.append(at - 1), guests.append(1)
                if x == first:
                    rows.append(i), ranges_of.append(len(heads)), guests.append(1)
            out = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(ranges_of, pa.int32()), pa.array(guests, pa.int32())],
                ["doc_id", "text", "range", "guest"],
            )

    def finish(rows: list[tuple[int | None, str, int]]) -> pa.RecordBatch:
        """Results of all rows but those that only follow others."""
        texts = [r[1] for r in rows]
        todo = [i for i in range(len(rows) - 1) if not rows[i][2]]
        edited = []
        for i in todo:
            half = len(texts[i]) // 2
            edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
        own = spot_sets(pa.array(texts, pa.large_string()))
        new = spot_sets(pa.array(edited, pa.large_string()))
        columns = [
            pa.array([rows[i][0] for i in todo], pa.int64()),
            pa.array([len(texts[i]) for i in todo], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array([told(own[i]) for i in todo], pa.string()),
            pa.array([told(s) for s in new], pa.string()),
            pa.array([likeness(own[i], s) for i, s in zip(todo, new)], pa.float64()),
            pa.array([likeness(own[i], own[i + 1]) for i in todo], pa.float64()),
        ]
        names = [f.split()[0] for f in _SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str, int]] = []
        size = 0
        for part in slices(batches):
            for x, text, guest in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "guest"))):
                if guest and held and held[-1][2]:
                    continue  # repeated rows of a head: the first one follows
                held.append((x, text, guest))
                size += len(text)
                if size >= SLICE_BYTES:
                    yield finish(held)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield finish(held)

    dealt = docs.mapInArrow(deal, "doc_id long, text string, range int, guest int")
    ordered = dealt.repartition(ranges, "range").sortWithinPartitions("range", "guest", "doc_id", "text")
    return ordered.mapInArrow(compare, _SCHEMA)
