"""SentencePiece encoding by suffix-array matching, and decoding.

The new words of a batch are concatenated and their suffixes sorted; a binary
search of every vocabulary piece yields the range of its occurrences, and each
occurrence is an edge over the text. Edges are sorted by position and relaxed
from left to right. For a byte-pair model the path is not the one of the best
sum of scores, but the one whose neighbours are all stable, that is, encode as
themselves when joined: each position has exactly one last piece whose
predecessor it is stable with. Words are encoded once per worker and cached;
no piece crosses from a word into the next one's leading spaces.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from canton.llm.arrays import SLICE_BYTES, give_back, slices

SPACE = "▁"
CACHE_WORDS = 150_000  # words of each of the two generations that a worker remembers
INDEX_CHARS = 250_000  # characters indexed at once
LONG_WORD = 200  # characters from which a word is walked alone, and not remembered
CACHE_PAIRS = 2_000_000  # decisions on neighbours a worker remembers
BATCH_BYTES = 2 * SLICE_BYTES


class Pieces:
    """The vocabulary of a byte-pair model with byte fallback, ready for matching."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(self.size)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(self.size)]
        byte = [model.is_byte(i) for i in range(self.size)]
        if sum(byte) != 256:
            raise ValueError(f"{path}: no byte fallback")
        plain = [i for i in range(self.size) if not (special[i] or byte[i] or model.is_unused(i))]
        self.text = {i: texts[i] for i in plain}
        self.id = {texts[i]: i for i in plain}
        self.score = {texts[i]: model.get_score(i) for i in plain}
        self.byte_id = np.zeros(256, np.int32)
        shown: list[bytes] = []
        for i, t in enumerate(texts):
            if byte[i]:
                self.byte_id[int(t[3:5], 16)] = i
                shown.append(bytes([int(t[3:5], 16)]))
            elif model.is_unknown(i):
                shown.append(" ⁇ ".encode())
            else:
                shown.append(b"" if special[i] else t.replace(SPACE, " ").encode())
        self.shown_size = np.array([len(s) for s in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        # Codes of the characters that pieces consist of: 2, 3, ...; 1 is any other, 0 ends a word.
        alphabet = np.array(sorted({ord(c) for i in plain for c in texts[i]}), np.uint32)
        if len(alphabet) > 0xFFF0:
            raise ValueError(f"{path}: too many characters")
        self.alphabet = alphabet
        self.width = max(len(texts[i]) for i in plain)
        grid = np.zeros((len(plain), self.width), np.uint16)
        for row, i in enumerate(plain):
            points = np.frombuffer(texts[i].encode("utf-32-le"), np.uint32)
            grid[row, : len(points)] = np.searchsorted(alphabet, points) + 2
        self.ids = np.array(plain, np.int64)
        self.length = np.array([len(texts[i]) for i in plain], np.int64)
        self.low = self._keys(grid)
        after = np.arange(self.width)[None, :] >= self.length[:, None]
        self.high = self._keys(np.where(after, np.uint16(0xFFFF), grid))
        # A line feed of which no longer piece makes use parts words as spaces do.
        parts = not any("\n" in t and len(t) > 1 for t in self.id)
        self.words = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+" if parts else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.pair_keys = np.zeros(0, np.int64)
        self.pair_stable = np.zeros(0, bool)

    def _keys(self, grid: np.ndarray) -> np.ndarray:
        """Rows of codes as byte strings that compare like the rows."""
        return np.ascontiguousarray(grid.astype(">u2")).view(f"S{2 * self.width}").ravel()

    def merged(self, text: str) -> list[str]:
        """Byte-pair encoding: the best-scored neighbours join, from the left on ties."""
        parts = list(text)
        while True:
            scored = [
                (-self.score[joined], i)
                for i in range(len(parts) - 1)
                if (joined := parts[i] + parts[i + 1]) in self.score
            ]
            if not scored:
                return parts
            _, i = min(scored)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _shape(self, piece: int) -> str:
        return self.text[piece] if piece < self.size else chr(piece - self.size)

    def stable(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the pieces stay as they are when joined. Ids from ``size`` on are characters."""
        keys = left << 32 | right
        asked, back = np.unique(keys, return_inverse=True)
        new = asked
        if len(self.pair_keys):
            at = np.minimum(np.searchsorted(self.pair_keys, asked), len(self.pair_keys) - 1)
            new = asked[self.pair_keys[at] != asked]
        if len(new):
            answers = []
            for key in new.tolist():
                a, b = self._shape(key >> 32), self._shape(key & 0xFFFFFFFF)
                answers.append(a + b not in self.id and self.merged(a + b) == [a, b])
            if len(self.pair_keys) + len(new) > CACHE_PAIRS:
                # Forget the others, but not what this call asks for.
                known = ~np.isin(asked, new)
                at = np.searchsorted(self.pair_keys, asked[known])
                self.pair_keys, self.pair_stable = asked[known], self.pair_stable[at]
            keys_all = np.concatenate([self.pair_keys, new])
            order = np.argsort(keys_all, kind="stable")
            self.pair_keys = keys_all[order]
            self.pair_stable = np.concatenate([self.pair_stable, np.array(answers, bool)])[order]
        return self.pair_stable[np.searchsorted(self.pair_keys, asked)][back]

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, id) of all occurrences of all pieces in the coded text."""
        padded = np.concatenate([codes, np.zeros(self.width, np.uint16)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.width)[: len(codes)]
        keys = self._keys(windows)
        suffixes = np.argsort(keys, kind="stable")
        keys = keys[suffixes]
        low = np.searchsorted(keys, self.low, side="left")
        count = np.searchsorted(keys, self.high, side="right") - low
        found = np.flatnonzero(count > 0)
        low, count = low[found], count[found]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
        return suffixes[place], np.repeat(self.length[found], count), np.repeat(self.ids[found], count)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as bytes of 32-bit numbers."""
        joined = "\0".join(words) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(sizes + 1) - sizes - 1
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        codes = np.where(self.alphabet[at] == points, at + 2, 1).astype(np.uint16)
        codes[begin + sizes] = 0
        start, length, piece = self.edges(codes)
        # A character that is no piece is an edge of its own.
        alone = np.ones(len(points), bool)
        alone[start[length == 1]] = False
        alone[begin + sizes] = False
        other = np.flatnonzero(alone)
        start = np.concatenate([start, other])
        length = np.concatenate([length, np.ones(len(other), np.int64)])
        piece = np.concatenate([piece, points[other].astype(np.int64) + self.size])
        origin = np.repeat(begin, sizes + 1)
        reach = start - origin[start] + length
        order = np.argsort(reach, kind="stable")
        start, piece, reach = start[order], piece[order], reach[order]
        stop = start + length[order]
        last = np.full(len(points) + 1, -1, np.int64)  # the piece that ends here
        came = np.zeros(len(points) + 1, np.int64)  # and where it starts
        last[begin] = -2
        bounds = np.searchsorted(reach, np.arange(1, int(sizes.max(initial=0)) + 2))
        for a, b in zip(bounds[:-1], bounds[1:]):
            before = last[start[a:b]]
            fits = before == -2
            ask = np.flatnonzero(before >= 0)
            if len(ask):
                fits[ask] = self.stable(before[ask], piece[a:b][ask])
            hit = np.flatnonzero(fits) + a
            last[stop[hit]] = piece[hit]
            came[stop[hit]] = start[hit]
        on_path = np.zeros(len(points) + 1, bool)
        at, active = begin + sizes, sizes > 0
        while active.any():
            on_path[at[active]] = True
            at = np.where(active, came[at], at)
            active &= at > begin
        ends = np.flatnonzero(on_path)
        ids = last[ends]
        counts = np.searchsorted(ends, begin + sizes, side="right") - np.searchsorted(ends, begin, side="right")
        cut = np.concatenate([[0], np.cumsum(counts)])
        whole, at = ids.astype(np.int32).tobytes(), (4 * cut).tolist()
        out = [whole[a:b] for a, b in zip(at, at[1:])]
        for i in np.unique(np.searchsorted(cut, np.flatnonzero(ids >= self.size), side="right") - 1).tolist():
            out[i] = self._with_bytes(ids[cut[i] : cut[i + 1]])
        return out

    def _with_bytes(self, ids: np.ndarray) -> bytes:
        """Characters that are no piece become the pieces of their bytes."""
        pieces = [
            np.array([x], np.int32) if x < self.size
            else self.byte_id[list(chr(x - self.size).encode())]
            for x in ids.tolist()
        ]
        return np.concatenate(pieces).tobytes()

    def _stable_pair(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS // 10:
                self.pairs.clear()
            a, b = self._shape(left), self._shape(right)
            known = self.pairs[key] = a + b not in self.id and self.merged(a + b) == [a, b]
        return known

    def encode_long(self, word: str) -> bytes:
        """The ids of one long word: indexed in parts that overlap by a piece, relaxed edge by edge."""
        n = len(word)
        last = np.full(n + 1, -1, np.int64)
        came = np.zeros(n + 1, np.int64)
        last[0] = -2
        held = [np.zeros(0, np.int64)] * 3
        for low in range(0, n, INDEX_CHARS):
            points = np.frombuffer(word[low : low + INDEX_CHARS + self.width - 1].encode("utf-32-le"), np.uint32)
            near = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
            start, length, piece = self.edges(np.where(self.alphabet[near] == points, near + 2, 1).astype(np.uint16))
            alone = np.ones(len(points), bool)
            alone[start[length == 1]] = False
            other = np.flatnonzero(alone)
            start = np.concatenate([start, other])
            length = np.concatenate([length, np.ones(len(other), np.int64)])
            piece = np.concatenate([piece, points[other].astype(np.int64) + self.size])
            mine = start < INDEX_CHARS
            start, length, piece = start[mine] + low, length[mine], piece[mine]
            start, stop, piece = (np.concatenate(x) for x in zip(held, (start, start + length, piece)))
            order = np.argsort(stop, kind="stable")
            ready = int((stop <= low + INDEX_CHARS).sum())
            held = [x[order[ready:]] for x in (start, stop, piece)]
            for a in range(0, ready, INDEX_CHARS):
                part = order[a : min(a + INDEX_CHARS, ready)]
                for s, t, p in zip(start[part].tolist(), stop[part].tolist(), piece[part].tolist()):
                    before = int(last[s])
                    if last[t] == -1 and (before == -2 or (before >= 0 and self._stable_pair(before, p))):
                        last[t], came[t] = p, s
        path, at = [], n
        while at > 0:
            path.append(int(last[at]))
            at = int(came[at])
        return self._with_bytes(np.array(path[::-1], np.int64))

    @staticmethod
    def _parts(words: list[str]) -> Iterator[list[str]]:
        """Lists of words of at most INDEX_CHARS characters, one word at least."""
        held, size = [], 0
        for word in words:
            if held and size + len(word) > INDEX_CHARS:
                yield held
                held, size = [], 0
            held.append(word)
            size += len(word)
        if held:
            yield held

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text: a space before it, spaces as the space mark."""
        split = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        ids: dict[str, bytes] = {}
        missing = []
        for word in {w for words in split for w in words}:
            known = self.cache.get(word)
            if known is None and (known := self.older.get(word)) is not None:
                self.cache[word] = known
            if known is not None:
                ids[word] = known
            elif len(word) > LONG_WORD:
                ids[word] = self.encode_long(word)
            else:
                missing.append(word)
        if len(self.cache) + len(missing) > CACHE_WORDS:
            # Words met since the last change of generations stay at hand.
            self.older, self.cache = self.cache, {}
        for part in self._parts(missing):
            new = dict(zip(part, self.encode_words(part)))
            ids.update(new)
            self.cache.update(new)
        get = ids.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids, without the leading space of the encoding."""
        size = self.shown_size[ids]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - self.shown_start[ids], size)
        shown = self.shown[place].tobytes()
        return (shown[1:] if shown[:1] == b" " else shown).decode("utf-8", "replace")


@functools.cache
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Slices gathered to BATCH_BYTES, for the words of many texts to be indexed at once."""
    held, size = [], 0
    for part in slices(batches):
        held.append(part)
        size += part.column("text").nbytes
        if size >= BATCH_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def encode_documents(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, ids, n_tokens and round_trip of every document.

    The ids are those of the library for the whole text, without begin or end
    marks. ``round_trip`` tells whether decoding gives the text back: it does
    unless the text holds the space mark itself, which decodes to a space.
    NULL and empty text have no ids. Repeated rows give repeated rows, a NULL
    doc_id stays, columns besides doc_id and text are ignored.
    """
    path = public_tokenizers.path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for table in _text_batches(batches):
            texts = [t or "" for t in table.column("text").to_pylist()]
            encoded = pieces.encode(texts)
            ids = np.frombuffer(b"".join(encoded), np.int32)
            counts = np.array([len(e) // 4 for e in encoded], np.int64)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            same = [pieces.decode(np.frombuffer(e, np.int32)) == t for e, t in zip(encoded, texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks(),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)),
                    pa.array(counts),
                    pa.array(same, pa.bool_()),
                ],
                ["doc_id", "ids", "n_tokens", "round_trip"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: give_back(run(batches)), "doc_id long, ids array<int>, n_tokens long, round_trip boolean")


def decode_documents(encoded: DataFrame, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id and the text of ``ids``; NULL ids give the empty text."""
    path = public_tokenizers.path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            texts = [pieces.decode(np.array(i or [], np.int64)) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
