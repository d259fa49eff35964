"""Exact removal of byte strings that stand more than once in a collection.

Candidates. A position of every ``length``-byte string is chosen by its content
alone: the least hash of an ``ANCHOR``-byte string in it (winnowing). Equal
strings have their anchor at one offset, so they meet under the anchor's hash,
each as an aligned context: all ``length``-byte strings around that anchor.

Decision. The contexts of a task form a collection whose suffixes are put in
order column by column, from the last to the first: each round inserts one
symbol per context and updates order (the positions in the Burrows-Wheeler
transform) and common prefixes of neighbours. The symbols come from, and are
read in the order of, a sequential external file. A string is repeated if a
neighbour shares ``length`` bytes with it.

Hot anchors. Equal contexts count once. If more than ``GROUP`` different ones
share an anchor, the strings are halved by their offset; the bytes that all
strings of a half share become the new key, until groups are small: at a single
offset the key is the string itself.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from canton.llm.arrays import mix, prefix_hash, slices, span_hash, utf8
from canton.session import stored_table as stored

LENGTH = 400
ANCHOR = 128
GROUP = 1_024  # different contexts of one key in a collection
COLLECTION = 8_192  # contexts after which a collection ends with its key


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending positions of the anchors of all strings inside one text, and their hashes."""
    span = length - size + 1  # anchor candidates of a string
    places = len(raw) - size + 1
    strings = len(raw) - length + 1
    if strings <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    prefix = prefix_hash(raw)
    at = np.arange(places)
    hashes = span_hash(prefix, at, at + size)
    # The place in the low bits breaks ties to the left.
    bits = max(1, int(places).bit_length())
    keyed = (hashes >> np.uint64(bits)) << np.uint64(bits) | at.astype(np.uint64)
    # Sliding minimum: of the rest of a block, and of the start of the next one.
    blocks = -(-places // span)
    grid = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    grid[:places] = keyed
    grid = grid.reshape(blocks, span)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[:strings], head[span - 1 : span - 1 + strings])
    starts = np.arange(strings)
    text = np.searchsorted(offsets, starts, side="right") - 1
    inside = starts + length <= offsets[text + 1]
    chosen = np.unique(least[inside] & np.uint64((1 << bits) - 1)).astype(np.int64)
    return chosen, hashes[chosen]


def _lists(per_text: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _scan(docs: DataFrame, length: int, size: int) -> DataFrame:
    """id, digest and length of every text, with the anchors of its strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            raw, offsets = utf8(part.column("text"))
            place, value = anchors(raw, offsets, length, size)
            text = np.searchsorted(offsets, place, side="right") - 1
            count = np.bincount(text, minlength=len(offsets) - 1)
            whole = raw.tobytes()
            digests = [hashlib.sha256(whole[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(digests, pa.binary()),
                    pa.array(np.diff(offsets)),
                    _lists(count, value.view(np.int64), pa.int64()),
                    _lists(count, (place - offsets[text]).astype(np.int32), pa.int32()),
                ],
                ["id", "digest", "n_bytes", "hashes", "places"],
            )

    schema = "id long, digest binary, n_bytes long, hashes array<long>, places array<int>"
    # A written row number identifies a row from then on.
    return docs.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


_CONTEXT = (
    "key long, d1 long, d2 long, row long, first int, last int, start int, context binary"
)
_NAMES = [f.split()[0] for f in _CONTEXT.split(", ")]


def _contexts(
    raw: np.ndarray, key: np.ndarray, row: np.ndarray, origin: np.ndarray, place: np.ndarray,
    low: np.ndarray, high: np.ndarray, first: np.ndarray, last: np.ndarray, length: int,
) -> pa.RecordBatch:
    """Contexts of the strings that start ``first`` to ``last`` bytes before an anchor.

    ``place`` is the anchor's place in raw, low:high its text's bytes there, and
    ``origin`` what turns places in raw into places in the text. Offsets whose
    strings leave the text are left out; anchors without any other are dropped.
    """
    first = np.maximum(first, length - (high - place))
    last = np.minimum(last, place - low)
    some = first <= last
    key, row, origin, place, first, last = (x[some] for x in (key, row, origin, place, first, last))
    begin, end = place - last, place - first + length
    prefix = prefix_hash(raw)
    d1 = span_hash(prefix, begin, end)
    # A second, independent digest from the context's own bytes with other weights.
    other = prefix_hash(raw ^ np.uint8(0x5A))
    d2 = mix(span_hash(other, begin, end) ^ np.uint64(0xC2B2AE3D27D4EB4F)) + (first * 1009 + last).astype(np.uint64)
    whole = raw.tobytes()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.view(np.int64)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
            pa.array(row), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
            pa.array((begin - origin).astype(np.int32)),
            pa.array([whole[a:b] for a, b in zip(begin, end)], pa.binary()),
        ],
        _NAMES,
    )


def _cut(texts: DataFrame, length: int, size: int) -> DataFrame:
    """The contexts of the anchors listed with each text."""
    span = length - size + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            raw, offsets = utf8(part.column("text"))
            count = part.column("places").value_lengths().to_numpy(zero_copy_only=False)
            text = np.repeat(np.arange(len(count)), count)
            place = part.column("places").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            key = part.column("keys").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            row = part.column("row").to_numpy(zero_copy_only=False)[text]
            origin = offsets[text]
            none, all_of = np.zeros(len(text), np.int64), np.full(len(text), span - 1)
            yield _contexts(raw, key, row, origin, origin + place, origin, offsets[text + 1], none, all_of, length)

    return texts.mapInArrow(run, _CONTEXT)


def _halve(contexts: DataFrame, length: int) -> DataFrame:
    """The contexts of each half of the offsets, keyed by what the half's strings share.

    The halves are those of the key's offsets (``least`` to ``most``), not of a
    context that its text's ends have shortened, so equal strings stay together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "context"):
            raw, offsets = utf8(part.column("context").cast(pa.large_binary()).view(pa.large_string()))
            column = lambda n: part.column(n).to_numpy(zero_copy_only=False)
            key, row = column("key").view(np.uint64), column("row")
            least, most, last = (column(n).astype(np.int64) for n in ("least", "most", "last"))
            place = offsets[:-1] + last
            origin = offsets[:-1] - column("start")
            middle = (least + most) // 2
            prefix = prefix_hash(raw)
            for low, high in ((least, middle), (middle + 1, most)):
                begin, end = place - low, place - high + length
                fits = (low <= high) & (begin >= offsets[:-1]) & (end <= offsets[1:])
                shared = np.zeros(len(key), np.uint64)
                shared[fits] = span_hash(prefix, begin[fits], end[fits])
                new = mix(mix(key + low.astype(np.uint64)) ^ shared)
                batch = _contexts(
                    raw, new[fits], row[fits], origin[fits], place[fits], offsets[:-1][fits],
                    offsets[1:][fits], low[fits], high[fits], length,
                )
                bounds = {n: dict(zip(new[fits].tolist(), x[fits].tolist())) for n, x in (("least", low), ("most", high))}
                keys = batch.column("key").to_numpy().view(np.uint64).tolist()
                extra = [pa.array([bounds[n][k] for k in keys], pa.int32()) for n in ("least", "most")]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*_NAMES, "least", "most"])

    return contexts.mapInArrow(run, _CONTEXT + ", least int, most int")


def repeated_offsets(contexts: list[bytes], last: np.ndarray, length: int) -> list[np.ndarray]:
    """Per context, the ascending starts of the strings that other contexts hold
    at the same distance from the anchor.

    Column c of a context stands ``c - max(last)`` bytes from its anchor.
    """
    n = len(contexts)
    shift = (int(last.max()) - last).astype(np.int64)
    sizes = np.fromiter(map(len, contexts), np.int64, n)
    width = int((shift + sizes).max())
    # Symbol 0 stands where a context has no byte.
    with tempfile.TemporaryFile() as columns:
        grid = np.zeros((n, width), np.uint16)
        for i, context in enumerate(contexts):
            grid[i, shift[i] : shift[i] + sizes[i]] = np.frombuffer(context, np.uint8)
            grid[i, shift[i] : shift[i] + sizes[i]] += 1
        columns.write(np.ascontiguousarray(grid[:, ::-1].T).tobytes())
        del grid
        columns.seek(0)
        order = np.arange(n)
        common = np.zeros(n, np.int64)  # of order[j - 1] and order[j]
        hits: list[tuple[int, np.ndarray]] = []
        for column in range(width - 1, -1, -1):
            symbol = np.frombuffer(columns.read(2 * n), np.uint16)[order]
            move = np.argsort(symbol, kind="stable")
            ordered = symbol[move]
            same = (ordered[1:] == ordered[:-1]) & (ordered[1:] > 0)
            at = np.flatnonzero(same) + 1
            new = np.zeros(n, np.int64)
            new[at] = 1 + _least_between(common, move[at - 1] + 1, move[at])
            order, common = order[move], new
            long = np.flatnonzero(common >= length)
            if len(long):
                hits.append((column, np.unique(order[np.concatenate([long - 1, long])])))
    out: list[list[int]] = [[] for _ in range(n)]
    for column, members in reversed(hits):
        for i in members.tolist():
            out[i].append(column - int(shift[i]))
    return [np.array(o, np.int64) for o in out]


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low..high], for each pair of bounds."""
    if not len(low):
        return np.zeros(0, values.dtype)
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    table = values
    out = np.empty(len(low), values.dtype)
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        own = level == k
        out[own] = np.minimum(table[low[own]], table[high[own] + 1 - (1 << k)])
    return out


_MARK = "row long, start int, stop int"


def _decide(contexts: DataFrame, length: int) -> DataFrame:
    """Marks of the repeated strings of small groups, one collection after another."""

    def flush(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        found = repeated_offsets([r[3] for r in rows], np.array([r[1] for r in rows]), length)
        marks: list[tuple[int, int, int]] = []
        for (row, _, start, _), offsets in zip(rows, found):
            if len(offsets):
                # All strings of a context overlap, gaps included: they hold the anchor.
                marks.append((row, start + int(offsets[0]), start + int(offsets[-1]) + length))
        columns = list(zip(*marks)) or [(), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["row", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        current = None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("key", "row", "last", "start", "context")]
            for key, *rest in zip(*columns):
                if len(held) >= COLLECTION and key != current:
                    yield flush(held)
                    held = []
                current = key
                held.append(tuple(rest))
        if held:
            yield flush(held)

    return contexts.mapInArrow(run, _MARK)


def _marks(contexts: DataFrame, length: int, size: int) -> DataFrame:
    """(row, start, stop) of the repeated strings around the anchors."""
    span = length - size + 1
    contexts = stored(
        contexts.withColumns({"least": F.lit(0), "most": F.lit(span - 1)}), "contexts"
    )
    marks = []
    while True:
        same = stored(
            contexts.groupBy("key", "d1", "d2").agg(
                F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start")).alias("one")
            ),
            "same",
        )
        groups = stored(
            same.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "groups"
        )
        # Equal contexts: every string of them is repeated.
        whole = contexts.join(same.where("n > 1").select("key", "d1", "d2"), ["key", "d1", "d2"]).select(
            "row", "start", (F.col("start") + length + F.col("last") - F.col("first")).alias("stop")
        )
        marks.append(stored(whole, "marks"))
        one = (
            contexts.join(same, ["key", "d1", "d2"])
            .where((F.col("one.row") == F.col("row")) & (F.col("one.start") == F.col("start")))
            .join(groups, "key")
        )
        small = one.where(F.col("size") <= GROUP).select("key", "row", "last", "start", "context")
        parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        marks.append(_decide(small.repartition(parts, "key").sortWithinPartitions("key", "row", "start"), length))
        large = groups.where(F.col("size") > GROUP)
        if not large.limit(1).count():
            break
        contexts = stored(_halve(one.where(F.col("size") > GROUP), length), "contexts")
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document.

    A byte of a text is removed if a string of ``length`` bytes that covers it
    starts at another place too, in this or another row; matches stay within a
    text. Strings are judged on the input: of equal places none is spared.
    Equal texts are examined once: they are removed whole if they have
    ``length`` bytes. NULL text is empty, shorter texts are kept, repeated rows
    are copies of each other, a NULL doc_id stays. Columns besides doc_id and
    text are ignored.
    """
    kept = kept_texts(docs, length, anchor)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def kept_texts(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """The rows of ``remove_repeats`` with ``kept``, what a text that lost a part keeps.

    ``kept`` is NULL where the text lost nothing or all.
    """
    docs = docs.select(
        # A NULL doc_id gets a stand-in, as a key.
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("doc_id").isNull().alias("unknown"),
    )
    scanned = stored(_scan(docs.select("id", "text"), length, anchor), "scanned")
    classes = stored(
        scanned.groupBy("digest").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies")), "classes"
    )
    units = scanned.join(classes.withColumnRenamed("row", "one"), "digest").where("row = one")
    found = units.select("row", "id", F.explode(F.arrays_zip("hashes", "places")).alias("a")).select(
        "row", F.col("a.hashes").alias("key"), F.col("a.places").alias("place")
    )
    common = stored(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "common")
    listed = (
        found.join(common, "key")
        .groupBy("row")
        .agg(F.collect_list("key").alias("keys"), F.collect_list("place").alias("places"))
        .join(units.select("row", "digest", "id"), "row")
    )
    texts = docs.select("id", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    # A row repeated with its doc_id brings its text twice. It is a copy, removed whole below
    # whatever its marks, and equal contexts of one row say nothing about other rows.
    cut = _cut(texts.join(listed, ["id", "digest"]), length, anchor)
    marks = _marks(cut, length, anchor)
    spans = marks.groupBy("row").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    single = units.where("copies = 1").select("row", "digest", "id")
    partial = _removed(texts.join(spans.join(single, "row"), ["id", "digest"]))
    copied = classes.where("copies > 1").select("digest").withColumn("copied", F.lit(True))
    empty = hashlib.sha256(b"").hexdigest()
    whole = F.col("copied").isNotNull() & (F.col("n_bytes") >= length)
    return (
        scanned.select("id", "digest", "n_bytes")
        .join(stored(copied, "copied"), "digest", "left")
        .join(stored(partial, "partial"), "digest", "left")
        .select(
            F.when(F.col("id") != -(1 << 63), F.col("id")).alias("doc_id"),
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
            F.when(whole, 1).otherwise(F.coalesce("found", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, F.lit(empty)).otherwise(F.coalesce("sha", F.lower(F.hex("digest")))).alias("kept_sha256"),
            F.when(~whole, F.col("kept")).alias("kept"),
        )
    )


def _removed(texts: DataFrame) -> DataFrame:
    """Per text with marks: bytes removed, maximal removed runs, and what is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            removed, runs, shas, kept_of = [], [], [], []
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                whole, kept, at, gone, count = text.encode(), [], 0, 0, 0
                end = -1
                for start, stop in sorted((s["start"], s["stop"]) for s in spans):
                    if start > end:
                        count += 1
                        kept.append(whole[at:start])
                        gone += stop - start
                        at = end = stop
                    elif stop > end:
                        gone += stop - end
                        at = end = stop
                kept.append(whole[at:])
                removed.append(gone)
                runs.append(count)
                kept_of.append(b"".join(kept))
                shas.append(hashlib.sha256(kept_of[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("digest"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                    pa.array(shas, pa.string()), pa.array(kept_of, pa.binary()),
                ],
                ["digest", "removed", "found", "sha", "kept"],
            )

    return texts.select("text", "digest", "spans").mapInArrow(
        run, "digest binary, removed long, found long, sha string, kept binary"
    )
