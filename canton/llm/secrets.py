"""Secret scanning: keyword prefilter, anchored patterns, checksum validation."""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from canton.llm.arrays import slices, utf8

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "checked")
_ORDER = {kind: n for n, kind in enumerate(KINDS)}

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CHECKED = re.compile(r"(?:gh[opsur]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_HEX_RUN = 32

_KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "checked": ("gho_", "ghp_", "ghs_", "ghu_", "ghr_", "npm_"),
}
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

Span = tuple[int, int, str]


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, keywords in _KEYWORDS.items():
        for keyword in keywords:
            automaton.add_word(keyword, (kind, len(keyword)))
    automaton.make_automaton()
    return automaton


def checksum_holds(body: str, check: str) -> bool:
    """Whether ``check`` is the CRC32 of ``body`` in six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = _DIGITS[digit] + digits
    return digits == check


def _accepted(kind: str, found: re.Match) -> bool:
    if kind == "assign":
        return len(found[2]) >= 8
    if kind == "access":
        return len(found[0]) >= 16
    return checksum_holds(found[1], found[2])


_PATTERNS = {"assign": _ASSIGN, "access": _ACCESS, "checked": _CHECKED}


def scan(text: str, hex_runs: bool = True) -> list[Span]:
    """(start, end, kind) of the secrets of ``text`` in code points, in order.

    Every match of a pattern starts with one of its keywords, so the patterns
    are tried at the automaton's hits only, each kind from left to right and
    behind its last match, accepted or not: leftmost and non-overlapping.
    ``hex_runs`` may be false if the text has no hexadecimal run of 32.
    """
    spans: list[Span] = []
    # Lower case of ASCII letters alone keeps all positions.
    lowered = text.encode().lower().decode()
    behind = dict.fromkeys(_PATTERNS, 0)
    hits = [(end - size + 1, kind) for end, (kind, size) in _automaton().iter(lowered)]
    for start, kind in sorted(hits):
        if start >= behind[kind] and (found := _PATTERNS[kind].match(text, start)):
            behind[kind] = found.end()
            if _accepted(kind, found):
                spans.append((start, found.end(), kind))
    if hex_runs:
        spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], _ORDER[s[2]]))


def _long_hex(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, whether a run of 32 hexadecimal digits may touch it."""
    digit = np.zeros(len(raw) + 2, np.int8)
    digit[1:-1] = ((raw >= 48) & (raw <= 57)) | ((raw >= 97) & (raw <= 102))
    change = np.diff(digit)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    long = ends - starts >= _HEX_RUN
    touched = np.zeros(len(offsets), np.int64)
    np.add.at(touched, np.searchsorted(offsets, starts[long], side="right") - 1, 1)
    np.add.at(touched, np.minimum(np.searchsorted(offsets, ends[long] - 1, side="right"), len(offsets) - 1), -1)
    return np.cumsum(touched)[:-1] > 0


def _told(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string,"
    " spans string, n_checked long"
)


def secret_scan(docs: DataFrame) -> DataFrame:
    """Secrets of every whole text.

    ``assign``, ``access`` and ``hex`` are the base kinds; ``checked`` adds
    tokens whose last six characters are the checksum of the rest. Hexadecimal
    runs have no keyword: a vectorised run-length test over the bytes of a
    slice is their prefilter. NULL text counts as empty: no spans, the digest
    of the empty string. Repeated rows give repeated rows, a NULL doc_id
    stays, columns besides doc_id and text are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            column = part.column("text")
            long_hex = _long_hex(*utf8(column))
            out: dict[str, list] = {n: [] for n in ("a", "c", "h", "sha", "spans", "k")}
            for text, hexes in zip(column.to_pylist(), long_hex):
                spans = scan(text, hexes) if text else []
                base = [s for s in spans if s[2] != "checked"]
                kinds = [s[2] for s in spans]
                out["a"].append(kinds.count("assign"))
                out["c"].append(kinds.count("access"))
                out["h"].append(kinds.count("hex"))
                out["k"].append(kinds.count("checked"))
                out["sha"].append(hashlib.sha256(_told(base).encode()).hexdigest())
                out["spans"].append(_told(spans))
            long, string = pa.int64(), pa.string()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(out["a"], long),
                    pa.array(out["c"], long),
                    pa.array(out["h"], long),
                    pa.array(out["sha"], string),
                    pa.array(out["spans"], string),
                    pa.array(out["k"], long),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_checked"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, _SCHEMA)
