"""Conversation structure repair: the cheapest edits that make the turns alternate.

The edits of a conversation are a path through a DAG of (row, inserts so far,
last role). A path's weight is one integer: its cost in the high digits, its
audit letters in the low ones, first letter highest, so that the least integer
is the least cost and, among equals, the ASCII-least audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from canton.llm.arrays import slices
from canton.session import broadcast_if_small as small, stored_table as stored

DIGIT = 3  # bits of an audit letter
LETTERS = ("", "D", "I", "K", "R")  # in ASCII order; 0 pads the end
DELETE, INSERT, KEEP, REROLE = range(1, 5)
FOLD = 256  # letters after which a lone layer's digits are folded into a rank

WHITE = " \t\n\x0b\x0c\r"
REPEATS = 200_000  # repeated turns that are broadcast; more are joined by a shuffle

#: From the last role's state, the states that a role initial leads to: (s?(ua)+)?
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
NAMES = {"u": "user", "a": "assistant"}


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    @property
    def inserts(self) -> bool:
        """Whether an inserted turn can be part of a cheapest repair.

        Take the turn that an inserted one pairs with: deleting it and leaving
        out the insert keeps the pattern and costs ``delete`` in place of
        ``insert``; where that pair is all that follows a system turn, two
        deletions do. So an insert dearer than two deletions never is.
        """
        return self.insert <= 2 * self.delete


class Repair:
    """The DAG over one conversation's rows, taken one by one in their order.

    Layer k holds the nodes with k inserts: per state the least weight, the
    running digest of its repaired turns and the letters folded so far. All
    nodes of a layer have equally many letters, hence weights of one width.
    """

    def __init__(self, costs: Costs):
        self.costs, self.rows = costs, 0
        self.layers: list[dict[int, tuple]] = [{0: (0, None, None)}]

    @staticmethod
    def _relax(layer: dict[int, tuple], state: int, node: tuple, cost: int, width: int, letter: int, data) -> None:
        weight = ((node[0] + (cost << width)) << DIGIT) | letter
        if state not in layer or weight < layer[state][0]:
            layer[state] = (weight, node, data)

    @staticmethod
    def _settle(layer: dict[int, tuple]) -> dict[int, tuple]:
        """Extend the digests of the edges that were chosen."""
        out = {}
        for state, (weight, (_, digest, folded), data) in layer.items():
            if data is not None:
                digest, first = (digest.copy(), b"\n") if digest else (hashlib.sha256(), b"")
                digest.update(first + data)
            out[state] = (weight, digest, folded)
        return out

    def _insert(self) -> None:
        for k in range(len(self.layers) + 2):  # a gap never needs more than two turns
            if k >= len(self.layers):
                break
            new: dict[int, tuple] = {}
            for state, node in self.layers[k].items():
                for initial, role in NAMES.items():
                    if initial in NEXT[state]:
                        self._relax(
                            new, NEXT[state][initial], node, self.costs.insert,
                            DIGIT * (self.rows + k), INSERT, f"{role}:".encode(),
                        )
            if k + 1 == len(self.layers):
                if k > 2 * self.rows + 2:
                    break
                self.layers.append({})
            for state, node in self._settle(new).items():
                old = self.layers[k + 1].get(state)
                if old is None or node[0] < old[0]:
                    self.layers[k + 1][state] = node

    def add(self, role: str, text: str, gone: bool, truncated: bool) -> None:
        """One more row; ``gone`` rows can only be deleted."""
        if self.costs.inserts:
            self._insert()
        extra = self.costs.truncated if truncated else 0
        body = text.encode()
        said = {i: f"{name}:".encode() + body for i, name in NAMES.items()}
        kept = f"{role}:".encode() + body
        for k, layer in enumerate(self.layers):
            width, new = DIGIT * (self.rows + k), {}
            for state, node in layer.items():
                self._relax(new, state, node, self.costs.delete, width, DELETE, None)
                if gone:
                    continue
                if role[:1] in NEXT[state]:
                    self._relax(new, NEXT[state][role[:1]], node, extra, width, KEEP, kept)
                for initial in NAMES:
                    if initial in NEXT[state]:
                        cost = self.costs.rerole + extra
                        self._relax(new, NEXT[state][initial], node, cost, width, REROLE, said[initial])
            self.layers[k] = self._settle(new)
        self.rows += 1
        if self.rows == FOLD and len(self.layers) == 1:
            self._fold()

    def _split(self, weight: int, letters: int) -> tuple[int, str]:
        """The cost and the letters of a weight."""
        digits = ((weight >> DIGIT * i) & 7 for i in range(letters - 1, -1, -1))
        return weight >> DIGIT * letters, "".join(LETTERS[d] for d in digits)

    def _fold(self) -> None:
        """Put the rank of each node's letters in their place.

        With one layer all audits are equally long, so later letters cannot
        change how the earlier ones compare: long conversations need no longer
        integers than short ones.
        """
        layer, mask = self.layers[0], (1 << DIGIT * self.rows) - 1
        rank = {low: i for i, low in enumerate(sorted({w & mask for w, _, _ in layer.values()}))}
        for state, (weight, digest, folded) in layer.items():
            cost, letters = self._split(weight & ~(7 << DIGIT * (self.rows - 1)) if folded else weight, self.rows)
            layer[state] = ((cost << DIGIT) | rank[weight & mask], digest, (folded, letters))
        self.rows = 1

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the least weight, shorter audits padded with zeros."""
        if self.costs.inserts:
            self._insert()
        most = self.rows + len(self.layers) - 1
        ends = [
            (node[0] << DIGIT * (most - self.rows - k), k, node)
            for k, layer in enumerate(self.layers)
            for state, node in layer.items()
            if state in ENDS
        ]
        _, k, (weight, digest, folded) = min(ends, key=lambda e: e[:2])
        letters = self.rows + k
        cost, audit = self._split(weight & ~(7 << DIGIT * (letters - 1)) if folded else weight, letters)
        parts = [audit]
        while folded:
            folded, audit = folded
            parts.append(audit)
        return cost, "".join(reversed(parts)), (digest or hashlib.sha256()).hexdigest()


class _Conversation:
    """What one conversation's rows add up to, in bounded memory but for its audit."""

    def __init__(self, conv_id, costs: Costs):
        self.conv_id, self.repair = conv_id, Repair(costs)
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.last = self.before = None

    def add(self, turn, role: str, text: str, blank: bool, seen: bool, cut: bool) -> None:
        if turn is not None and (self.turns == 0 or turn != self.last[0]):
            self.turns += 1
            self.low = turn if self.low is None else self.low
        if self.last is not None and role[:1] + self.last[1][:1] not in ("us", "au", "ua"):
            self.illegal += 1
        # Equal rows of one turn stand beside each other.
        duplicate = not blank and (seen or self.last == (turn, role, text))
        truncated = cut and not blank and not duplicate
        self.last = (turn, role, text)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.repair.add(role, text, blank or duplicate, truncated)

    def row(self) -> tuple:
        gaps = self.last[0] - self.low + 1 - self.turns if self.turns else 0
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result()
        )


_OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SCHEMA = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _OUT.split(", ")])


def _walk(costs: Costs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: _Conversation | None = None
        for batch in slices(batches):
            done = []
            names = ("conv_id", "dropped", "turn", "role", "text", "blank", "seen", "cut")
            for conv_id, dropped, *row in zip(*(batch.column(n).to_pylist() for n in names)):
                if at is None or at.conv_id != conv_id:
                    if at is not None:
                        done.append(at.row())
                    at = _Conversation(conv_id, costs)
                if not dropped:
                    at.add(*row)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r)) for r in done], _SCHEMA)
        if at is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, at.row()))], _SCHEMA)

    return run


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults made by crc32 of ``conv_id:turn`` modulo 20.

    0 marks the row as ``dropped``, 1 empties the text, 2 takes out its ``.!?``,
    3 repeats the row, 4 makes the role ``user``. NULL ids, roles and texts read
    as one space; a repeated row is damaged alike each time.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("fault"),
    )
    fault = F.col("fault")
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repair_conversations(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row per conv_id: its faults and the cheapest repair to ``(s?(ua)+)?``.

    A conversation's rows stand by turn (NULL first), rows of one turn by role
    and text; rows marked in a boolean column ``dropped``, if there is one, only
    name their conversation. Each row's first fault counts: ``blank`` (white
    space only), ``duplicate`` (role and text of an earlier row), ``truncated``
    (the last sign is none of ``.!?``). ``illegal`` counts neighbours whose role
    initials are not su, ua or au, ``gaps`` the missing turn numbers. Keeping a
    row is free, another role, a deletion and an inserted empty turn have their
    costs, and a truncated row that stays costs more; blank and duplicate rows
    must go. Of equally cheap repairs the ASCII-least ``audit`` (D, I, K, R in
    order) counts; ``repaired_sha256`` is over the repaired ``role:text`` lines.

    NULL roles and texts read as one space, NULL conv_ids are one conversation.
    Repeated rows are duplicates. Other columns are ignored; an empty table
    gives no rows. Rows are dealt out by conversation and walked in one sorted
    pass that holds one row, a node per state and the audit: a digest is
    sequential, so a conversation is one task's work, of whatever length. With
    costs that make inserts worth while (``Costs.inserts``), memory grows with
    the rows of a conversation and time with their square.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in turns.columns else F.lit(False)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        space("role"), space("text"), dropped.alias("dropped"),
    )
    said = ("conv_id", "role", "text")
    rows = rows.withColumns({"h1": F.xxhash64(*said), "h2": F.xxhash64(F.lit(1), *said)})
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # NULL turns come first
    repeated = rows.where(~F.col("dropped")).groupBy("h1", "h2").agg(
        F.min(when).alias("first"), F.count(F.lit(1)).alias("times")
    )
    repeated = small(stored(repeated.where("times > 1").select("h1", "h2", "first"), "repeated-turns"), REPEATS)
    ended = F.rtrim("text", F.lit(WHITE))
    flagged = rows.join(repeated, ["h1", "h2"], "left").select(
        "conv_id", "turn", "role", "text", "dropped",
        (ended == "").alias("blank"),
        F.coalesce(when > F.col("first"), F.lit(False)).alias("seen"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    dealt = flagged.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_walk(costs), _OUT)
