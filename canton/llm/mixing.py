"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell of source, language and topic. The cells' weights
are raked: scaled to the target shares of one margin after another until all
hold. Documents are then sampled with probabilities in proportion to their
cell's weight, calibrated to a token budget.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from canton.llm.arrays import prefix_hash, slices, span_hash, utf8, words
from canton.session import broadcast_if_small as small, stored_table as stored

MARGINS = ("source", "lang", "topic")
TEMPER = 0.7  # default targets: observed token shares to this power
BUDGET = 0.5  # share of the tokens to sample
TOLERANCE = 1e-6  # of a margin's shares
SWEEPS = 60
PAIRS = 100_000  # combinations of language and topic: both are closed sets
CELL_ROWS = 200_000  # cells that are broadcast at most

TOPICS = 8
SEEDS = 256  # texts that the centres may start from; all texts move them
ROUNDS = 30  # of k-means at most
LANGS = 1_024  # that a task sums at once
_DIMENSIONS = 256
#: Coordinates are summed as integers, so that no sum hangs on its order.
_SCALE = float(1 << 28)


def _bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word counts of each text in hashed dimensions, and its number of words."""
    raw, offsets = utf8(column)
    starts, ends, first = words(raw, offsets)
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    bucket = (span_hash(prefix_hash(raw), starts, ends) % np.uint64(_DIMENSIONS)).astype(np.int64)
    bags = np.bincount(text * _DIMENSIONS + bucket, minlength=len(count) * _DIMENSIONS)
    return bags.reshape(len(count), _DIMENSIONS), count


def _packed(bags: np.ndarray) -> pa.Array:
    """Each bag as bytes: one per count, or four if one count needs more."""
    wide = bags.max(axis=1, initial=0) > 255
    narrow = bags.astype(np.uint8)
    return pa.array(
        [(bags[i].astype(np.uint32) if w else narrow[i]).tobytes() for i, w in enumerate(wide)], pa.binary()
    )


def _unpacked(column: pa.Array) -> np.ndarray:
    """Directions of the log counts of packed bags."""
    held = column.to_pylist()
    wide = np.array([len(x) > _DIMENSIONS for x in held], bool)
    bags = np.zeros((len(held), _DIMENSIONS))
    for kind, rows in ((np.uint8, np.flatnonzero(~wide)), (np.uint32, np.flatnonzero(wide))):
        bags[rows] = np.frombuffer(b"".join([held[i] for i in rows]), kind).reshape(len(rows), _DIMENSIONS)
    return _unit(np.log1p(bags))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


class Topics:
    """Centres of spherical k-means over word-count directions, each centred on its language.

    Without that, topics would repeat the languages and the two margins could
    not be held together.
    """

    def __init__(self, means: dict[str | None, np.ndarray], centres: np.ndarray):
        self.means, self.centres = means, centres

    def directions(self, column: pa.Array, langs: pa.Array) -> np.ndarray:
        rows = _unpacked(column)
        kinds = langs.dictionary_encode("encode")
        means = [self.means.get(x, np.zeros(_DIMENSIONS)) for x in kinds.dictionary.to_pylist()]
        return _unit(rows - np.array(means).reshape(-1, _DIMENSIONS)[kinds.indices.to_numpy()])

    def nearest(self, points: np.ndarray) -> np.ndarray:
        # Rounded, so that a tie does not hang on the batch a text came in.
        return np.round(points @ self.centres.T, 9).argmax(axis=1)


def bagged(docs: DataFrame) -> DataFrame:
    """doc_id, text hash, source, lang, n_tokens (words) and packed word counts of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            bags, count = _bags(part.column("text"))
            kept = [part.column(n) for n in ("doc_id", "mark", "source", "lang")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(count.astype(np.int64)), _packed(bags)],
                ["doc_id", "mark", "source", "lang", "n_tokens", "bag"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("mark"),
        *[F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")],
    )
    return rows.mapInArrow(run, "doc_id long, mark long, source string, lang string, n_tokens long, bag binary")


def _sums(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sums of their rows in units of 1 / _SCALE, and their numbers of rows."""
    order = np.argsort(keys, kind="stable")
    known, first, times = np.unique(keys[order], return_index=True, return_counts=True)
    whole = np.round(rows[order] * _SCALE).astype(np.int64)
    return known, np.add.reduceat(whole, first, axis=0), times


def _gathered(rows: DataFrame, key: str, kind: str, parts) -> dict:
    """{key: (sum, count)} over the partial sums that ``parts`` makes of each batch of rows.

    A task adds up its own; one group per key adds up the tasks.
    """

    def told(held: dict) -> pa.RecordBatch:
        sums = pa.array([x.tobytes() for x, _ in held.values()], pa.binary())
        type_ = pa.string() if kind == "string" else pa.int32()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), type_), sums, pa.array([n for _, n in held.values()], pa.int64())], [key, "sums", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for name, total, n in parts(batch):
                have, times = held.get(name, (0, 0))
                held[name] = (have + total, times + n)
            if len(held) > LANGS:
                yield told(held)
                held = {}
        if held:
            yield told(held)

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(_DIMENSIONS, np.int64)
        for x in group.column("sums").to_pylist():
            total += np.frombuffer(x, np.int64)
        n = int(group.column("n").to_numpy().sum())
        return pa.table([group.column(key).slice(0, 1), pa.array([total.tobytes()]), pa.array([n])], [key, "sums", "n"])

    schema = f"{key} {kind}, sums binary, n long"
    found = rows.mapInArrow(run, schema).groupBy(key).applyInArrow(add, schema).collect()
    return {r[key]: (np.frombuffer(bytes(r["sums"]), np.int64) / _SCALE, r["n"]) for r in found}


def _seeds(rows: DataFrame) -> tuple[pa.Array, pa.Array]:
    """Bags and languages of at most SEEDS distinct texts, those of least hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            # Of equal texts the one of least language.
            table = table.sort_by([("mark", "ascending"), ("lang", "ascending")])
            _, first = np.unique(table.column("mark").to_numpy(), return_index=True)
            held = table.take(pa.array(first[:SEEDS])).combine_chunks().to_batches()
            held = held[0] if held else None
        if held is not None:
            yield held

    least = (
        rows.mapInArrow(run, "mark long, lang string, bag binary")
        .groupBy("mark")
        .agg(F.min(F.struct(F.col("lang").isNull().alias("none"), "lang", "bag")).alias("row"))
        .orderBy("mark")
        .limit(SEEDS)
        .select("row.bag", "row.lang")
        .collect()
    )
    return pa.array([bytes(r["bag"]) for r in least], pa.binary()), pa.array([r["lang"] for r in least], pa.string())


def fit_topics(rows: DataFrame, topics: int = TOPICS) -> Topics:
    """Topics of all texts of a stored ``bagged`` table; texts without words have no say.

    Language means and centres are sums over every row, added up in the tasks;
    only the means, the centres and the seeds reach the driver.
    """
    spark = rows.sparkSession
    rows = rows.where("n_tokens > 0").select("mark", "lang", "bag")

    def by_language(batch: pa.RecordBatch) -> Iterator[tuple]:
        kinds = batch.column("lang").dictionary_encode("encode")
        names = kinds.dictionary.to_pylist()
        if batch.num_rows:
            for k, total, n in zip(*_sums(kinds.indices.to_numpy(), _unpacked(batch.column("bag")))):
                yield names[k], total, int(n)

    means = {x: total / n for x, (total, n) in _gathered(rows, "lang", "string", by_language).items()}
    model = Topics(means, np.zeros((1, _DIMENSIONS)))
    bags, langs = _seeds(rows)
    if not len(bags):
        return model
    points = model.directions(bags, langs)
    # Each centre starts at the seed farthest from those before it.
    centres = [points[0]]
    for _ in range(1, min(topics, len(points))):
        near = np.max(points @ np.array(centres).T, axis=1)
        centres.append(points[int(np.round(near, 9).argmin())])
    model.centres = np.array(centres)
    for _ in range(ROUNDS):
        known = spark.sparkContext.broadcast(model)

        def by_centre(batch: pa.RecordBatch) -> Iterator[tuple]:
            points = known.value.directions(batch.column("bag"), batch.column("lang"))
            if len(points):
                for k, total, n in zip(*_sums(known.value.nearest(points), points)):
                    yield int(k), total, int(n)

        found = _gathered(rows, "centre", "int", by_centre)
        known.destroy()
        new = np.array([_unit(found[k][0][None])[0] if k in found else c for k, c in enumerate(model.centres)])
        done = np.allclose(new, model.centres, atol=1e-9)
        model = Topics(means, new)
        if done:
            break
    return model


def with_topics(rows: DataFrame, model: Topics) -> DataFrame:
    """doc_id, text hash, source, lang, topic and n_tokens of each row of a ``bagged`` table."""
    known = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            topic = known.value.nearest(known.value.directions(part.column("bag"), part.column("lang")))
            kept = [part.column(n) for n in ("doc_id", "mark", "source", "lang")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(topic.astype(np.int32)), part.column("n_tokens")],
                ["doc_id", "mark", "source", "lang", "topic", "n_tokens"],
            )

    return rows.mapInArrow(run, "doc_id long, mark long, source string, lang string, topic int, n_tokens long")


def _value(column: str) -> Column:
    """A margin's value as a key; NULL is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("NULL"))


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    """(value, share): observed token shares to a power below 1 lift what is rare."""
    mass = cells.groupBy(margin).agg(F.sum("n_tokens").alias("n")).where("n > 0")
    lifted = mass.select(F.col(margin).alias("value"), F.pow(F.col("n").cast("double"), F.lit(power)).alias("lifted"))
    total = lifted.agg(F.sum("lifted")).first()[0] or 1.0
    return lifted.select("value", (F.col("lifted") / total).alias("share"))


def _constant(values: np.ndarray) -> Column:
    """Numbers as one constant array."""
    return F.from_json(F.lit(json.dumps([float(v) for v in values])), "array<double>")


def _goal(target: DataFrame | None, mass: dict[str, float]) -> np.ndarray | None:
    """Target shares of the values that have tokens, scaled to 1; of others 0."""
    if target is None:
        return None
    share = {r["value"]: float(r["share"]) for r in target.select("value", "share").collect()}
    goal = np.array([share.get(v, 0.0) * (m > 0) for v, m in mass.items()])
    return goal / (goal.sum() or 1.0)


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` with ``mass``: token shares whose margins have the target shares.

    ``cells`` has a row per (source, lang, topic) with n_tokens. A target has
    (value, share); values no cell has are left out and the rest scaled up,
    values without a target get no mass, a margin without targets is left
    free. Sources may be any number: each is one row with the tokens of its
    (lang, topic) pairs, scales itself to its share, and adds to a sum per
    pair. One such pass is a sweep; from its sums, at most PAIRS numbers, the
    driver scales languages and topics. Sweeps end when every margin is within
    TOLERANCE, or (targets that contradict each other) after ``sweeps``.
    """
    spark = cells.sparkSession
    sums = cells.groupBy("lang", "topic").agg(F.sum("n_tokens").alias("n")).orderBy("lang", "topic")
    found = sums.limit(PAIRS + 1).collect()
    if len(found) > PAIRS:
        raise ValueError(f"more than {PAIRS} pairs of language and topic")
    total = float(sum(r["n"] for r in found)) or 1.0
    kinds, goals, place = {}, {}, {}
    for margin in ("lang", "topic"):
        mass: dict[str, float] = {}
        for r in found:
            mass[r[margin]] = mass.get(r[margin], 0.0) + r["n"]
        kinds[margin] = list(mass)
        goals[margin] = _goal(targets.get(margin), mass)
        at = {v: i for i, v in enumerate(mass)}
        place[margin] = np.array([at[r[margin]] for r in found], np.int64)
    numbered = spark.createDataFrame(
        [(r["lang"], r["topic"], i) for i, r in enumerate(found)], "lang string, topic string, pair int"
    )
    paired = cells.join(F.broadcast(numbered), ["lang", "topic"])  # at most PAIRS rows
    entry = F.struct("pair", (F.col("n_tokens") / total).alias("n"))
    sources = paired.groupBy("source").agg(
        F.collect_list(entry).alias("pairs"), F.sum("n_tokens").alias("n_tokens")
    )
    if "source" in targets:
        goal = targets["source"].select(F.col("value").alias("source"), F.col("share").cast("double").alias("share"))
        sources = sources.join(goal, "source", "left").withColumn(
            "share", F.when(F.col("n_tokens") > 0, F.coalesce("share", F.lit(0.0))).otherwise(0.0)
        )
        sources = stored(sources, "sources")
        whole = sources.agg(F.sum("share")).first()[0] or 1.0
        share = F.col("share") / whole
    else:
        sources, share = stored(sources, "sources"), None

    def own_factor(factors: Column) -> Column:
        if share is None:
            return F.lit(1.0)
        mass = F.aggregate("pairs", F.lit(0.0), lambda a, x: a + x["n"] * F.get(factors, x["pair"]))
        return F.coalesce(F.when(mass > 0, share / mass), F.lit(0.0))

    factors, before = np.ones(len(found)), np.ones(len(found))
    for _ in range(sweeps):
        scaled = sources.select(own_factor(_constant(factors)).alias("own"), F.explode("pairs").alias("p"))
        rows = scaled.groupBy("p.pair").agg(F.sum(F.col("own") * F.col("p.n")).alias("mass")).collect()
        mass = np.zeros(len(found))
        for r in rows:
            mass[r["pair"]] = r["mass"]
        mass *= factors
        before, worst = factors.copy(), 0.0
        for margin, goal in goals.items():
            if goal is not None:
                now = np.bincount(place[margin], weights=mass, minlength=len(kinds[margin]))
                worst = max(worst, float(np.abs(now - goal).max(initial=0)))
                ratio = np.divide(goal, now, out=np.zeros(len(now)), where=now > 0)[place[margin]]
                mass, factors = mass * ratio, factors * ratio
        if worst <= TOLERANCE:
            break
    own = sources.select("source", own_factor(_constant(before)).alias("own"))
    mass = F.col("own") * F.get(_constant(factors), F.col("pair")) * F.col("n_tokens") / total
    return paired.join(own, "source").select(*cells.columns, mass.alias("mass"))


def probabilities(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``cells`` with ``weight`` and ``probability``.

    The weight is raked over observed token share. Probabilities are the least
    of 1 and scale * weight, with the scale at which ``budget`` of the tokens
    are expected; once some cells are at 1, the others make up for them.
    """
    total = float(cells.agg(F.sum("n_tokens")).first()[0] or 0)
    weight = F.when(F.col("n_tokens") > 0, F.col("mass") * total / F.col("n_tokens"))
    cells = cells.withColumn("weight", weight)
    scale = budget
    while True:
        full = F.col("weight") * scale >= 1
        taken, rest = cells.agg(
            F.sum(F.when(full, F.col("n_tokens"))), F.sum(F.when(~full, F.col("n_tokens") * F.col("weight")))
        ).first()
        if not rest:
            break
        new = (budget * total - (taken or 0)) / rest
        if new <= scale * (1 + 1e-12):
            break
        scale = new
    # A cell without tokens costs nothing: its documents follow the budget.
    probability = F.coalesce(F.least(F.lit(1.0), F.col("weight") * scale), F.lit(float(budget)))
    return cells.withColumn("probability", probability)


def sample_mix(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    budget: float = BUDGET,
    seed: int = 5,
    topics: int = TOPICS,
) -> DataFrame:
    """One row per document: its cell, weight, probability and whether it is sampled.

    Margins are source, language and topic, a cluster of the text's words;
    ``targets`` has a (value, share) frame per margin to be held, by default
    the tempered observed shares of all three. The sample takes a document if
    a uniform hash of seed, doc_id and text falls below its probability, so
    reruns and repeated rows agree. NULL sources and languages are values of
    their own; NULL text is empty. Columns besides doc_id, text, source and
    lang are ignored.
    """
    bags = stored(bagged(docs), "bags")
    rows = stored(with_topics(bags, fit_topics(bags, topics)), "topics")
    keyed = rows.select("doc_id", "mark", "n_tokens", *[_value(m).alias(m) for m in MARGINS])
    cells = stored(keyed.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("n_tokens")), "cells")
    if targets is None:
        goals = {m: tempered(cells, m) for m in MARGINS}
    else:
        goals = {m: t.select(_value("value").alias("value"), "share") for m, t in targets.items()}
    decided = stored(probabilities(rake(cells, goals), budget), "cells")
    # 53 bits of a hash, as a number from 0 to 1.
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "mark"), 11) / F.lit(float(1 << 53))
    return (
        keyed.join(small(decided.drop("n_tokens", "mass"), CELL_ROWS), list(MARGINS))
        .select(
            "doc_id", "mark", "n_tokens", *MARGINS,
            F.coalesce("weight", F.lit(0.0)).alias("weight"), "probability",
            (draw < F.col("probability")).alias("sampled"),
        )
    )


def keep_sampled(docs: DataFrame, **options) -> DataFrame:
    """The documents that ``sample_mix`` samples, with their columns."""
    chosen = sample_mix(docs, **options).where("sampled").select("doc_id", "mark").distinct()
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("mark"),
    )
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.mark") == F.col("b.mark"))
    kept = marked.alias("a").join(chosen.alias("b"), same, "left_semi")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
