"""Token counts of texts by a two-tier lookup on the map side.

Tier one is a broadcast table of the token counts of frequent pre-tokens.
Tier two encodes what is missing there and remembers it in a bounded cache of
the worker. No pre-token is ever shuffled; the documents pass once.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from canton.llm.arrays import slices

TABLE_SIZE = 65_536  # pre-tokens in the broadcast table, about 4 MB at most
SAMPLE_DOCS = 4_096  # documents whose pre-tokens may enter it
PRE_TOKEN_BYTES = 48  # longer ones are never frequent
CACHE_SIZE = 200_000  # pre-tokens a worker remembers besides the table

_SCHEMA = "doc_id long, n_bytes long, n_tokens long"


@functools.cache
def _encoder(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(path)
    encoder.no_truncation()
    encoder.no_padding()
    return encoder


def _specials(path: str) -> list[str]:
    return [t.content for t in _encoder(path).get_added_tokens_decoder().values()]


@functools.cache
def _splitter():
    return regex.compile(public_tokenizers.PATTERN)


@functools.cache
def _unsettled() -> re.Pattern:
    """Characters that the two pattern engines may class differently.

    The engines carry different Unicode versions. Characters of the basic plane
    that Unicode 3.2 already had are classed alike (a test compares all code
    points); texts with others are encoded by the library as a whole.
    """
    old, ranges, start = unicodedata.ucd_3_2_0, [], None
    for code in range(0x10001):
        settled = code < 0x10000 and old.category(chr(code)) != "Cn"
        if settled and start is None:
            start = code
        elif not settled and start is not None:
            ranges.append(f"\\u{start:04x}-\\u{code - 1:04x}")
            start = None
    return re.compile(f"[^{''.join(ranges)}]")


def _lengths(path: str, pieces: list[str]) -> list[int]:
    return [len(e) for e in _encoder(path).encode_batch(pieces, add_special_tokens=False)]


class _Tiers(dict):
    """Frequent pre-tokens for good; others until the cache is full."""

    def __init__(self, path: str, table: dict[str, int]):
        super().__init__(table)
        self.path, self.table, self.encoded = path, table, 0

    def learn(self, pieces: list[str]) -> None:
        missing = [p for p in set(pieces) if p not in self]
        if len(self) + len(missing) > len(self.table) + CACHE_SIZE:
            self.clear()
            self.update(self.table)
            missing = [p for p in set(pieces) if p not in self]
        if missing:
            self.encoded += len(missing)
            self.update(zip(missing, _lengths(self.path, missing)))


_TIERS: list[tuple[object, _Tiers]] = []  # of the last broadcast this worker saw


def _tiers(path: str, table: dict[str, int]) -> _Tiers:
    if not _TIERS or _TIERS[0][0] is not table:
        _TIERS[:] = [(table, _Tiers(path, table))]
    return _TIERS[0][1]


def frequent_pre_tokens(docs: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the commonest pre-tokens of at most SAMPLE_DOCS documents.

    The sample is spread over the whole table by a hash. It only decides what
    is looked up and what is encoded: the counts never depend on it. The
    driver receives at most TABLE_SIZE pre-tokens.
    """
    every = max(1, docs.count() // SAMPLE_DOCS)
    sample = (
        docs.select("text")
        .where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("text"), F.lit(every)) == 0))
        .limit(SAMPLE_DOCS)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                seen.update(_splitter().findall(text))
            if len(seen) > 8 * TABLE_SIZE:
                seen = Counter(dict(seen.most_common(4 * TABLE_SIZE)))
        top = [(p, n) for p, n in seen.most_common(TABLE_SIZE) if len(p.encode()) <= PRE_TOKEN_BYTES]
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array([p for p, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    # limit() leaves one partition: one bounded list reaches the driver.
    rows = sample.mapInArrow(count, "piece string, n long").collect()
    pieces = [r["piece"] for r in rows]
    return dict(zip(pieces, _lengths(path, pieces))) if pieces else {}


def token_counts(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document.

    Texts are split by the pre-tokenizer's pattern, the tokens of each
    pre-token are looked up or encoded once, and the counts are summed. A text
    that holds a special string of the vocabulary is encoded as a whole, since
    the library takes such a string as one token, and so is a text with
    characters newer than Unicode 3.2. NULL text counts as empty
    (0 bytes, 0 tokens); repeated rows give repeated rows; a NULL doc_id stays.
    Columns besides doc_id and text are ignored.
    """
    path = public_tokenizers.path(vocabulary)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(frequent_pre_tokens(docs, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiers = _tiers(path, table.value)
        unsettled = _unsettled().search
        specials, split = _specials(path), _splitter().findall
        for part in slices(batches):
            ids, n_bytes, n_tokens = part.column("doc_id"), [], []
            for text in part.column("text").to_pylist():
                text = text or ""
                n_bytes.append(len(text.encode()))
                if any(s in text for s in specials) or not text.isascii() and unsettled(text):
                    n_tokens.append(_lengths(path, [text])[0])
                    continue
                pieces = split(text)
                try:
                    n_tokens.append(sum(map(tiers.__getitem__, pieces)))
                except KeyError:
                    tiers.learn(pieces)
                    n_tokens.append(sum(map(tiers.__getitem__, pieces)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return docs.mapInArrow(run, _SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
