"""Which unit a vanished one went into: links between periods and their closure.

A unit is a key inside an area; from one period to the next it stays, vanishes
or is new. A vanished unit is linked to a new unit of its area that shares rare
words of its name; what no name decides goes, by size, where new units have
room left. Links of consecutive periods close to the latest unit of each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from canton.functions.text import slugify
from canton.session import stored_table

# Words that tell no two places apart.
COMMON_WORDS = ("d", "de", "des", "du", "en", "et", "l", "la", "le", "les", "saint", "sainte", "sous", "sur")
WEIGHT = 1_000_000  # of a word that one unit holds; whole numbers add up alike in any order
SUBSET_WORDS = 8  # of a name whose 255 subsets are looked up

_BLOCK = ["step", "area"]


def unit_changes(units: DataFrame) -> DataFrame:
    """``units`` (period, area, key, name, size) with what becomes of each.

    Adds ``before`` and ``after``, the neighbouring periods of the table, and
    ``is_new`` and ``is_gone``: the key is missing in that neighbour, not in a
    table that has none. One shuffle by key; only the distinct periods, a few,
    meet in one task.
    """
    by_period = Window.orderBy("period")
    periods = units.select("period").distinct().withColumns(
        {"before": F.lag("period").over(by_period), "after": F.lead("period").over(by_period)}
    )
    by_key = Window.partitionBy("area", "key").orderBy("period")
    seen = units.withColumns({"last": F.lag("period").over(by_key), "next": F.lead("period").over(by_key)})
    return (
        seen.join(F.broadcast(periods), "period")  # one row per period
        .withColumns(
            {
                "is_new": F.col("before").isNotNull() & ~F.col("last").eqNullSafe(F.col("before")),
                "is_gone": F.col("after").isNotNull() & ~F.col("next").eqNullSafe(F.col("after")),
            }
        )
        .drop("last", "next")
    )


def _named(rows: DataFrame, common: Sequence[str]) -> DataFrame:
    """Units with the sorted set of words of their name; those without words are left out."""
    listed = F.array_except(F.split(slugify(F.col("name")), "_"), F.array(*map(F.lit, ["", *common])))
    return rows.select(*_BLOCK, "key", "size", F.array_sort(listed).alias("words")).where(F.size("words") > 0)


def _subsets(entries: Column) -> Column:
    """All non-empty subsets of sorted (word, weight) entries as (words, score)."""
    none = F.array(F.struct(F.array().cast("array<string>").alias("subset"), F.lit(0).cast("long").alias("score")))
    grown = F.aggregate(
        entries, none,
        lambda found, e: F.concat(found, F.transform(found, lambda s: F.struct(
            F.concat(s["subset"], F.array(e["word"])).alias("subset"), (s["score"] + e["weight"]).alias("score")
        ))),
    )
    return F.slice(grown, 2, F.size(grown))


def _by_name(gone: DataFrame, new: DataFrame, common: Sequence[str], slack: float) -> DataFrame:
    """The new unit that shares the rarest words with each vanished one, if any.

    Units of one area and set of words differ in size only, and the largest new
    one stands for all of them. No pairs of sets are built either: of all new
    sets that hold some words the largest unit counts, and a vanished set looks
    up each subset of its words. The unit with the best weight is what its own
    shared words find, and no other finds more than it shares. Only a name of
    more than ``SUBSET_WORDS`` words that both sides hold meets other sets word
    by word.
    """
    a, b = _named(gone, common), _named(new, common)
    units = a.withColumn("late", F.lit(False)).unionByName(b.withColumn("late", F.lit(True)))
    top = F.min(F.when(F.col("late"), F.struct((-F.col("size")).alias("small"), F.col("key").alias("to_key"))))
    sets = stored_table(
        units.groupBy(*_BLOCK, "words").agg(F.count_if("late").alias("n_new"), F.count_if(~F.col("late")).alias("n_gone"), top.alias("top")),
        "name-sets",
    )
    exploded = sets.withColumn("word", F.explode("words"))
    weights = (
        exploded.groupBy(*_BLOCK, "word")
        .agg(F.expr(f"{WEIGHT} DIV (sum(n_new) + sum(n_gone))").alias("weight"), F.sum("n_new").alias("late"), F.sum("n_gone").alias("early"))
        .where("late > 0 AND early > 0")
        .drop("late", "early")
    )
    met = stored_table(
        exploded.join(weights, [*_BLOCK, "word"])
        .groupBy(*_BLOCK, "words")
        .agg(F.array_sort(F.collect_list(F.struct("word", "weight"))).alias("entries"), F.first("top").alias("top"),
             F.max("n_gone").alias("n_gone")),
        "shared-words",
    )
    early, late = met.where("n_gone > 0").drop("top"), met.where("top IS NOT NULL").drop("n_gone")
    few = F.size("entries") <= SUBSET_WORDS
    offers = (
        late.where(few)
        .select(*_BLOCK, "top", F.inline(_subsets(F.col("entries"))))
        .groupBy(*_BLOCK, "subset")
        .agg(F.min("top").alias("top"))
    )
    found = early.where(few).select(*_BLOCK, "words", F.inline(_subsets(F.col("entries")))).join(offers, [*_BLOCK, "subset"])

    def paired(left: DataFrame, right: DataFrame) -> DataFrame:
        left = left.select(*_BLOCK, "words", F.inline("entries"))
        right = right.select(*_BLOCK, "top", F.explode("entries.word").alias("word"))
        return left.join(right, [*_BLOCK, "word"]).groupBy(*_BLOCK, "words", "top").agg(F.sum("weight").alias("score"))

    choice = F.struct((-F.col("score")).alias("rank"), "top.small", "top.to_key").alias("choice")
    columns = [*_BLOCK, "words", choice]
    choices = (
        found.select(*columns)
        .unionByName(paired(early.where(~few), late).select(*columns))
        .unionByName(paired(early.where(few), late.where(~few)).select(*columns))
        .groupBy(*_BLOCK, "words")
        .agg(F.array_sort(F.collect_set("choice")).alias("choices"))
    )
    fits = F.filter("choices", lambda c: F.col("size") <= -c["small"] * (1 + slack))
    return (
        a.join(choices, [*_BLOCK, "words"])
        .select(*_BLOCK, "key", F.get(fits, F.lit(0)).alias("best"))
        .where("best IS NOT NULL")
        .select(*_BLOCK, "key", F.col("best.to_key").alias("to_key"), (-F.col("best.rank")).alias("score"))
    )


def _by_size(gone: DataFrame, new: DataFrame) -> DataFrame:
    """Vanished units laid end to end over the room of the new ones, both by falling size.

    A unit goes where its middle falls; beyond the last room it goes nowhere.
    One sorted pass per area: the last room that began before a unit is its own.
    """
    def spans(rows: DataFrame, size: str) -> DataFrame:
        until = Window.partitionBy(*_BLOCK).orderBy(F.desc(size), "key").rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("stop", F.sum(size).over(until)).withColumn("start", F.col("stop") - F.col(size))

    none = F.lit(None)
    rooms = spans(new.where("room > 0"), "room").select(
        *_BLOCK, (2 * F.col("start")).alias("place"), none.cast("string").alias("key"),
        F.struct("key", (2 * F.col("stop")).alias("stop")).alias("room"),
    )
    middles = spans(gone, "size").select(
        *_BLOCK, (F.col("start") + F.col("stop")).alias("place"), "key", none.cast(rooms.schema["room"].dataType).alias("room")
    )
    sofar = Window.partitionBy(*_BLOCK).orderBy("place", F.col("room").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rooms.unionByName(middles)
        .withColumn("room", F.last("room", ignorenulls=True).over(sofar))
        .where(F.col("key").isNotNull() & (F.col("place") < F.col("room.stop")))
        .select(*_BLOCK, "key", F.col("room.key").alias("to_key"))
    )


def merge_links(units: DataFrame, common: Sequence[str] = COMMON_WORDS, slack: float = 0.1) -> DataFrame:
    """(period, area, key, to_period, to_key, method, score): what each unit is in the next period.

    ``units`` has one row per (period, area, key) with a text key, a name and a
    whole size (registered voters). A key that stays is linked to itself
    (``same``). A vanished one goes to the new unit of its area with the
    greatest weight of shared words (``name``; a word weighs a million divided
    by its holders, ``common`` ones nothing) that is at least its size less
    ``slack``, ties to the larger and then the smaller key; else by room
    (``size``); else it has no link. Units of the last period have none. NULL
    names share no words, a NULL size counts 0; rows without key, area or
    period are left out.
    """
    clean = units.select(
        "period", "area", F.col("key").cast("string").alias("key"), "name",
        F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size"),
    ).dropna(subset=["period", "area", "key"])
    changes = stored_table(unit_changes(clean), "units")
    gone = changes.where("is_gone").select(F.col("after").alias("step"), "area", "key", "name", "size", "period")
    new = changes.where("is_new").select(F.col("period").alias("step"), "area", "key", "name", "size")
    named = stored_table(_by_name(gone, new, common, slack), "named")
    filled = (
        gone.join(named, [*_BLOCK, "key"]).groupBy(*_BLOCK, F.col("to_key").alias("key")).agg(F.sum("size").alias("taken"))
    )
    room = F.greatest(F.col("size") - F.coalesce("taken", F.lit(0)), F.lit(0)).alias("room")
    rooms = new.join(filled, [*_BLOCK, "key"], "left").select(*_BLOCK, "key", room)
    rest = gone.join(named, [*_BLOCK, "key"], "left_anti").select(*_BLOCK, "key", "size")
    sized = _by_size(rest, rooms).withColumns({"method": F.lit("size"), "score": F.lit(0).cast("long")})
    found = named.withColumn("method", F.lit("name")).unionByName(sized)
    moved = gone.select(*_BLOCK, "key", "period").join(found, [*_BLOCK, "key"])
    stayed = changes.where("after IS NOT NULL AND NOT is_gone").select(
        F.col("after").alias("step"), "area", "key", "period", F.col("key").alias("to_key"),
        F.lit("same").alias("method"), F.lit(0).cast("long").alias("score"),
    )
    return moved.unionByName(stayed).select(
        "period", "area", "key", F.col("step").alias("to_period"), "to_key", "method", "score"
    )


def latest_units(units: DataFrame, links: DataFrame) -> DataFrame:
    """(period, area, key, latest_period, latest_key, n_merged): the end of each unit's links.

    Pointers double in every round, so k periods take log2(k) joins. ``n_merged``
    is the number of different keys, its own included, that end in the same
    latest unit.
    """
    at = units.select("period", "area", F.col("key").cast("string").alias("key")).dropna().distinct()
    step = links.select("period", "area", "key", "to_period", "to_key")
    ends = stored_table(
        at.join(step, ["period", "area", "key"], "left").select(
            "period", "area", "key",
            F.coalesce("to_period", "period").alias("to_period"), F.coalesce("to_key", "key").alias("to_key"),
        ),
        "ends",
    )
    reached, periods = 1, at.select("period").distinct().count()
    while reached < periods - 1:
        ahead = ends.select(
            F.col("period").alias("to_period"), "area", F.col("key").alias("to_key"),
            F.col("to_period").alias("far_period"), F.col("to_key").alias("far_key"),
        )
        ends = stored_table(
            ends.join(ahead, ["to_period", "area", "to_key"]).select(
                "period", "area", "key", F.col("far_period").alias("to_period"), F.col("far_key").alias("to_key")
            ),
            "ends",
        )
        reached *= 2
    latest = ends.withColumnsRenamed({"to_period": "latest_period", "to_key": "latest_key"})
    counts = (
        latest.select("latest_period", "area", "latest_key", "key")
        .distinct()
        .groupBy("latest_period", "area", "latest_key")
        .agg(F.count(F.lit(1)).alias("n_merged"))
    )
    return latest.join(counts, ["latest_period", "area", "latest_key"]).select(
        "period", "area", "key", "latest_period", "latest_key", "n_merged"
    )


def carried_forward(facts: DataFrame, latest: DataFrame, measures: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Facts of all periods summed on the latest unit of their key.

    ``facts`` has period, area, key and the measures (or measure: output name).
    Facts of merged units add up before they move: the join sees one row per
    unit and period.
    """
    names = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    narrow = facts.groupBy("period", "area", F.col("key").cast("string").alias("key")).agg(
        *[F.sum(m).alias(name) for m, name in names.items()]
    )
    return (
        narrow.join(latest, ["period", "area", "key"])
        .groupBy("latest_period", "area", "latest_key", "n_merged", "period")
        .agg(*[F.sum(name).alias(name) for name in names.values()], F.count(F.lit(1)).alias("n_keys"))
    )
