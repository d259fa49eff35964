"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
Short windows of a text are compressed with the ordinary dictionary and with
the toxic one put behind it: what the second saves is the window's gain.
Thresholds on the gains, counted over all windows of a text, are calibrated to
a probability on labelled texts that the dictionaries have not seen.

Toxic text for training is taken from toxic documents by contrast: words whose
character strings are much commoner there than in ordinary documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from canton.llm.arrays import SLICE_BYTES, release_memory, slices, utf8

WINDOW = 5  # words
ORDINARY_BYTES = 16_384
TOXIC_BYTES = 8_192
LEVEL = 3
GAINS = (2, 3, 4, 5, 6, 7, 8, 10)  # bytes saved
THRESHOLD = 0.3
#: The bounded sample of labelled rows that the model is fitted on.
SAMPLE_TOXIC = 3_000
SAMPLE_ORDINARY = 6_000
SAMPLE_WINDOWS = 40_000  # that the ordinary dictionary is trained on, about

_GRAM = 5
_RATIO = 20.0  # how much commoner a character string is in toxic documents
_LEAST = 3  # toxic documents that have it

_SOLID = np.zeros(256, bool)
_SOLID[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def normal(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case words, a space before each and one behind each text.

    Returns the bytes, the n + 1 offsets of the texts, the places of the spaces
    before the words, and the text of each word.
    """
    raw, offsets = utf8(column)
    solid = _SOLID[raw]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    begins[inner] = solid[inner]
    size = solid.astype(np.int64) + begins
    ends = np.concatenate([[0], np.cumsum(size)])
    texts = len(offsets) - 1
    # One more space behind every text.
    shift = np.repeat(np.arange(texts), np.diff(offsets))
    out = np.full(int(ends[-1]) + texts, 32, np.uint8)
    at = np.flatnonzero(solid)
    out[ends[at + 1] - 1 + shift[at]] = _LOWER[raw[at]]
    words = np.flatnonzero(begins)
    return out, ends[offsets] + np.arange(texts + 1), ends[words] + shift[words], shift[words]


def windows(column: pa.Array, width: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, int]:
    """Bytes, starts and ends of the windows, the text of each, and the number of texts."""
    out, offsets, words, text = normal(column)
    texts = len(offsets) - 1
    first = np.searchsorted(text, np.arange(texts + 1))
    count = -(-np.diff(first) // width)
    owner = np.repeat(np.arange(texts), count)
    begin = first[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * width
    stop = np.minimum(begin + width, first[owner + 1])
    last = stop == first[owner + 1]
    ends = np.where(last, offsets[owner + 1], words[np.minimum(stop, max(len(words) - 1, 0))] + 1 if len(words) else 0)
    return out.tobytes(), words[begin] if len(words) else begin, ends, owner, texts


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def _sizes(compressor: zstandard.ZstdCompressor, text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.int64)
    segments = np.column_stack([starts, ends - starts]).astype(np.uint64)
    buffer = zstandard.BufferWithSegments(text, segments.tobytes())
    out = compressor.multi_compress_to_buffer(buffer)
    return np.fromiter((len(s) for s in out), np.int64, len(starts))


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on the samples.

    Too few or too uniform samples cannot train one; their own bytes serve then.
    """
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" "


def _chunks(texts: list[str]) -> Iterator[pa.Array]:
    """Parts of a sample of about SLICE_BYTES, so that arrays over it stay small."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield pa.array(held, pa.large_string())
            held, size = [], 0
    if held:
        yield pa.array(held, pa.large_string())


def _grams(out: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The string of _GRAM bytes at each place, its text, and whether it stays in the text."""
    gram = np.zeros(max(len(out) - _GRAM + 1, 0), np.uint64)
    for k in range(_GRAM):
        gram = gram << np.uint64(8) | out[k : len(gram) + k].astype(np.uint64)
    text = np.searchsorted(offsets, np.arange(len(gram)), side="right") - 1
    return gram, text, np.arange(len(gram)) + _GRAM <= offsets[text + 1]


def _document_counts(texts: list[str], among: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending strings and the number of texts that have each; only those ``among``, if given."""
    known = np.zeros(0, np.uint64) if among is None else among
    counts = np.zeros(len(known))
    for column in _chunks(texts):
        out, offsets, _, _ = normal(column)
        gram, text, inside = _grams(out, offsets)
        pairs = np.unique(gram[inside] | text[inside].astype(np.uint64) << np.uint64(8 * _GRAM))
        grams, times = np.unique(pairs & np.uint64((1 << 8 * _GRAM) - 1), return_counts=True)
        if among is None:
            merged, at = np.unique(np.concatenate([known, grams]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, times]), minlength=len(merged))
            known = merged
        elif len(known):
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            hit = known[at] == grams
            counts[at[hit]] += times[hit]
    return known, counts


def contrasting_words(texts: list[str], toxic: np.ndarray) -> list[bytes]:
    """Words of toxic texts most of whose strings of _GRAM bytes stand out there."""
    bad_texts = [t for t, y in zip(texts, toxic) if y]
    known, bad = _document_counts(bad_texts, None)
    known, bad = known[bad >= _LEAST], bad[bad >= _LEAST]
    _, good = _document_counts([t for t, y in zip(texts, toxic) if not y], known)
    share = (bad / max(toxic.sum(), 1)) / ((good + 1) / max((~toxic).sum(), 1))
    known = known[share >= _RATIO]
    chosen: list[bytes] = []
    for column in _chunks(bad_texts):
        out, offsets, words, owner = normal(column)
        gram, _, inside = _grams(out, offsets)
        if not (len(known) and len(gram) and len(words)):
            continue
        at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
        hit = np.concatenate([[0], np.cumsum((known[at] == gram) & inside)])
        # A word ends with the space before the next one, or behind the text.
        ends = np.append(words[1:], len(out) - 1)
        ends = np.where(np.append(owner[1:] != owner[:-1], True), offsets[owner + 1] - 1, ends) + 1
        strings = np.maximum(ends - words - _GRAM + 1, 0)
        last = len(hit) - 1
        hits = hit[np.minimum(words + strings, last)] - hit[np.minimum(words, last)]
        whole = out.tobytes()
        chosen += [whole[words[i] : ends[i]] for i in np.flatnonzero((strings > 0) & (2 * hits >= strings))]
    return chosen


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    width: int = WINDOW
    usable: bool = True  # calibrated on both classes

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """The model with its compressors, which a task makes for itself."""

    def __init__(self, model: Model):
        self.model = model
        self.plain = _compressor(model.ordinary)
        self.both = _compressor(model.ordinary + model.toxic)

    def features(self, column: pa.Array) -> np.ndarray:
        text, starts, ends, owner, texts = windows(column, self.model.width)
        gain = _sizes(self.plain, text, starts, ends) - _sizes(self.both, text, starts, ends)
        count = np.bincount(owner, minlength=texts)
        most = np.zeros(texts)
        np.maximum.at(most, owner, gain)
        total = np.bincount(owner, weights=np.maximum(gain - 2, 0), minlength=texts)
        columns = [np.ones(texts), np.log1p(count), most, np.log1p(total), total / np.maximum(count, 1)]
        for g in GAINS:
            at_least = np.bincount(owner, weights=gain >= g, minlength=texts)
            columns += [np.log1p(at_least), at_least / np.maximum(count, 1)]
        return np.column_stack(columns)

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probabilities; a text without words shows nothing toxic and gets 0."""
        features = self.features(column)
        margin = np.clip(features @ self.model.weights, -40, 40)
        return np.where(features[:, 1] > 0, 1 / (1 + np.exp(-margin)), 0.0)


def _calibrated(features: np.ndarray, toxic: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic weights by Newton steps under a small L2 penalty."""
    weights = np.zeros(features.shape[1])
    ridge = np.full(features.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -40, 40)))
        gradient = features.T @ (p - toxic) + ridge * weights
        curve = (features * (p * (1 - p))[:, None]).T @ features + np.diag(ridge)
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(weights)), gradient)
        weights -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(texts: list[str], toxic: list[int], width: int = WINDOW) -> Model:
    """A model of labelled texts: two in three train the dictionaries, the rest calibrate.

    Without any label the score of texts with words is 1/2; with one class only
    it follows that class. Such a model is not ``usable``: it tells no text
    from another.
    """
    flags = np.array(toxic, bool)
    turn = np.zeros(len(flags), np.int64)
    for value in (False, True):
        turn[flags == value] = np.arange((flags == value).sum())
    shown = turn % 3 != 2
    plain = [t for t, s, y in zip(texts, shown, flags) if s and not y]
    step = max(1, sum(map(len, plain)) // (30 * SAMPLE_WINDOWS))
    samples: list[bytes] = []
    for column in _chunks(plain):
        text, starts, ends, _, _ = windows(column, width)
        samples += [text[a:b] for a, b in zip(starts[::step], ends[::step])]
    ordinary = _trained(samples, ORDINARY_BYTES)
    standing_out = contrasting_words([t for t, s in zip(texts, shown) if s], flags[shown])
    # Each word counts for its spread, not for its frequency.
    samples = sorted(set(standing_out)) * 8
    model = Model(ordinary, _trained(samples, TOXIC_BYTES), np.zeros(5 + 2 * len(GAINS)), width)
    if (~shown).any():
        scorer = model.scorer()
        rest = [scorer.features(c) for c in _chunks([t for t, s in zip(texts, shown) if not s])]
        model.weights = _calibrated(np.concatenate(rest), flags[~shown].astype(float))
    model.usable = len(set(flags[~shown].tolist())) == 2
    return model


def _fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(doc_id.cast("string")) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """At most SAMPLE_TOXIC and SAMPLE_ORDINARY labelled rows outside the held-out fold.

    The rows are those of least hash of their ids, each with its whole text, and
    repeated texts count once.
    """
    marks = (
        labels.select("doc_id", "toxic")
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (_fold(F.col("doc_id")) != 2))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts: dict[str, int] = {}
    for value, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        ids = marks.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        rows = (
            docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where(F.col("text").isNotNull())
            .join(F.broadcast(ids.select(F.col("doc_id").cast("long").alias("doc_id"))), "doc_id")  # at most ``most`` ids
        )
        # A repeated doc_id brings no more rows than the sample may have.
        found = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(most).collect()
        for r in found:
            texts.setdefault(r["text"], value)
    return list(texts), list(texts.values())


def _sent(docs: DataFrame, model: Model) -> Broadcast[Model]:
    """The model for the tasks. What the fit took is free by now and would stay with the driver."""
    release_memory()
    return docs.sparkSession.sparkContext.broadcast(model)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text.

    NULL texts and texts without words get the score 0; a NULL doc_id
    is in no fold (held_out false). Repeated rows give repeated rows, columns
    besides doc_id and text are ignored.
    """
    known = _sent(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = known.value.scorer()
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scorer.scores(part.column("text")))], ["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(_fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, in one pass.

    All rows stay if the labels were too few for the model to be ``usable``.
    """
    if not model.usable:
        return docs
    known = _sent(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = known.value.scorer()
        for part in slices(batches):
            yield part.filter(pa.array(scorer.scores(part.column("text")) < threshold))

    return docs.mapInArrow(run, docs.schema)
