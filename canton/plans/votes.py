"""Vote files: bronze rows to the conformed silver table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from canton.functions import (
    code_text, count_or_fail, decimal_point, half_even, iso_text, pct, plain_number, strip, to_double, to_long,
    whole,
)
from canton.operators.aggregates import first_and_sum, keep_first, vote_totals
from canton.operators.quality import Rule
from canton.operators.shaping import matching_columns, slot_count, unpivot_slots
from canton.plans import layouts as L
from canton.sources.delimited import file_order


def numeric_columns(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Columns whose name holds a pattern become doubles (decimal comma allowed)."""
    chosen = set(matching_columns(df, patterns))
    return df.select(
        *[
            (to_double(decimal_point(F.col(f"`{c}`"))) if c in chosen else F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )


def _counts(c: str, strict: bool) -> Column:
    """A count; ``strict`` fails on text that is no whole number, else it is NULL."""
    return _count(F.col(f"`{c}`"), strict)


def _count(value: Column, strict: bool) -> Column:
    return count_or_fail(value) if strict else to_long(value, decimal_comma=True)


def readable_counts(bronze: DataFrame, slots: int | None = None) -> list[Rule]:
    """A quality rule per count column: its texts are whole numbers.

    For runs that coerce counts instead of stopping (``strict=False``).
    """
    n = slots or slot_count(bronze.columns, list(L.SLOT_FIELDS))
    names = [*L.COUNT_FIELDS, *[f"Voix_{k}" for k in range(1, n + 1)]]
    broken = {c: F.col(f"`{c}`").isNotNull() & _counts(c, False).isNull() for c in names}
    return [Rule(f"{c}_readable", b, critical=False) for c, b in broken.items()]


def commune_totals(
    bronze: DataFrame, keys: Mapping[str, str], strict: bool = True
) -> DataFrame:
    """Station counts summed per key, with turnout shares."""
    stations = bronze.select(
        *[F.col(f"`{src}`").alias(out) for src, out in keys.items()],
        *[_counts(src, strict).alias(out) for src, out in L.COUNT_FIELDS.items()],
    )
    totals = vote_totals(stations, list(keys.values()), L.COUNTS)
    return totals.withColumns(
        {
            name: pct(F.col(a), F.col(b), guard)
            for name, (a, b, guard) in L.TURNOUT_SHARES.items()
        }
    )


def candidate_votes(
    bronze: DataFrame, keys: Mapping[str, str], slots: int | None = None, strict: bool = True
) -> DataFrame:
    """Votes per key and candidate from the wide slots."""
    n = slots or slot_count(bronze.columns, list(L.SLOT_FIELDS))
    rows = unpivot_slots(bronze, list(keys), L.SLOT_FIELDS, n).withColumnsRenamed(dict(keys))
    rows = rows.withColumn("voix", _counts("voix", strict))
    candidate = ["numero_panneau", "sexe", "nom", "prenom"]
    return vote_totals(rows, [*keys.values(), *candidate], ["voix"])


def ballot_totals(
    bronze: DataFrame, keys: Mapping[str, str], slots: int | None = None, strict: bool = True
) -> DataFrame:
    """Votes per key and candidate beside the counts of the key, from one pass over the stations.

    Stations of a key with the same ballot (the candidates of all slots) are
    added up as wide rows, and only these are unpivoted: the stations are
    neither read twice nor multiplied by their slots before the shuffle.
    Equals ``candidate_votes`` joined to the counts of ``commune_totals``.
    """
    n = slots or slot_count(bronze.columns, list(L.SLOT_FIELDS))
    names, range_ = list(keys.values()), range(1, n + 1)
    ballot = {src: out for src, out in L.SLOT_FIELDS.items() if out != "voix"}

    def listed(k: int) -> Column:  # a slot that names no candidate counts nothing, whatever its votes
        return reduce(lambda a, b: a & b, [F.col(f"`{src}_{k}`").isNotNull() for src in ballot])

    names_of_counts = [*L.COUNTS, *[f"voix_{k}" for k in range_]]
    texts = [F.col(f"`{src}`").cast("string") for src in L.COUNT_FIELDS]
    texts += [F.when(listed(k), F.col(f"`Voix_{k}`").cast("string")) for k in range_]
    stations = bronze.dropna(subset=[f"`{src}`" for src in keys]).select(
        *[F.col(f"`{src}`").alias(out) for src, out in keys.items()],
        *[F.col(f"`{src}_{k}`").alias(f"{out}_{k}") for src, out in ballot.items() for k in range_],
        *[text.alias(name) for name, text in zip(names_of_counts, texts)],
    )
    if strict:  # each text is parsed once
        stations = stations.withColumns({f"number_{name}": plain_number(F.col(name)) for name in names_of_counts})

    def count(name: str) -> Column:
        return count_or_fail(F.col(name), F.col(f"number_{name}")) if strict else _counts(name, False)

    identity = [f"{out}_{k}" for out in ballot.values() for k in range_]
    # Counts are read inside their sums, which are generated as a method each:
    # in one projection they would be too large to be compiled, in an array interpreted.
    # The ballot is one key: as columns of their own its candidates would be hashed
    # and compared one by one for every station, also where they are all alike.
    ballots = stations.groupBy(*names, F.struct(*identity).alias("ballot")).agg(
        *[F.sum(count(name)).alias(name) for name in names_of_counts]
    ).select(*names, "ballot.*", *names_of_counts)
    same_key = Window.partitionBy(*names)
    counted = ballots.withColumns({c: F.sum(c).over(same_key) for c in L.COUNTS})
    rows = unpivot_slots(counted, [*names, *L.COUNTS], list(L.SLOT_FIELDS.values()), n)
    return (
        rows.dropna(subset=list(ballot.values()))
        .groupBy(*names, *L.COUNTS, *ballot.values())
        .agg(F.sum("voix").alias("voix"))
    )


def with_election(df: DataFrame, year: int, round_: int) -> DataFrame:
    return df.withColumns(
        {"annee_election": F.lit(year).cast("long"), "tour": F.lit(round_).cast("long")}
    )


def enrich(
    df: DataFrame,
    reference: DataFrame,
    on: Mapping[str, str],
    order: Column | str,
) -> DataFrame:
    """Left join a reference by trimmed keys with other names.

    ``on`` maps a column of ``df`` to its column in ``reference``. Repeated
    reference keys keep the first row in ``order``: ``file_order()`` for a
    file, a line number for a literal table (a column by name is left out of
    the result).
    """
    left_out = {*on.values(), *([order] if isinstance(order, str) else [])}
    kept = [c for c in reference.columns if c not in left_out]
    ref = reference.select(
        *[strip(F.col(f"`{c}`")).alias(f"ref__{c}") for c in on.values()],
        *[F.col(f"`{c}`") for c in kept],
        (F.col(f"`{order}`") if isinstance(order, str) else order).alias("ref__order"),
    )
    ref_keys = [f"ref__{c}" for c in on.values()]
    ref = keep_first(ref, ref_keys, "ref__order")
    left = df.withColumns({c: strip(F.col(c)) for c in on})
    condition = [left[c] == ref[f"ref__{r}"] for c, r in on.items()]
    return left.join(ref, condition, "left").drop(*ref_keys, "ref__order")


def conform_votes(
    df: DataFrame, source_dataset: str, date_refresh: str | None = None
) -> DataFrame:
    """Canonical codes, trimmed names and typed numbers in the silver order."""
    refreshed = F.lit(date_refresh) if date_refresh else iso_text(F.current_timestamp())
    as_text = ("libelle_departement", "libelle_commune", "nom", "prenom", "nuance")
    as_count = (*L.ELECTION_KEYS, *L.COUNTS, "numero_panneau", "voix")
    special = {
        "code_departement": code_text(F.col("code_departement"), 2),
        "code_commune": code_text(F.col("code_commune"), 3),
        "source_dataset": F.lit(source_dataset),
        "date_refresh": refreshed,
    }

    types = dict(df.dtypes)

    def typed(name: str) -> Column:
        if name in special:
            return special[name]
        if name in as_text:
            return strip(F.col(name))
        if types[name] == ("bigint" if name in as_count else "double"):
            return F.col(name)
        if name in as_count:
            return to_long(F.col(name))
        return F.col(name) if name == "sexe" else to_double(F.col(name))

    return df.select(*[typed(c).alias(c) for c in L.SILVER_VOTES])


def silver_votes(
    bronze: DataFrame,
    reference: DataFrame,
    source_dataset: str,
    election: tuple[int, int] | None = None,
    date_refresh: str | None = None,
    on: Mapping[str, str] | None = None,
    slots: int | None = None,
    strict: bool = True,
    order: Column | str | None = None,
) -> DataFrame:
    """Wide bronze stations to one row per commune and candidate.

    Without ``election`` the bronze table carries ``annee_election`` and
    ``tour`` itself and any number of elections is processed in one plan.
    ``order`` says which of repeated reference rows is the first; the default,
    their place in the file, asks for a reference that is a plain file scan.
    Unreadable counts fail the job unless ``strict`` is false.
    """
    keys = dict(L.AREA_FIELDS)
    if election is None:
        keys |= {c: c for c in L.ELECTION_KEYS}
    shares = {**L.TURNOUT_SHARES, **L.VOTE_SHARES}
    rows = ballot_totals(bronze, keys, slots, strict).withColumns(
        {name: pct(F.col(a), F.col(b), guard) for name, (a, b, guard) in shares.items()}
    )
    if election is not None:
        rows = with_election(rows, *election)
    first = file_order() if order is None else order
    rows = enrich(rows, reference, on or {"nom": "nom", "prenom": "prenom"}, first)
    return conform_votes(rows, source_dataset, date_refresh)


def stations_to_communes(
    bronze: DataFrame,
    order: Column | str,
    keys: Sequence[str] = ("Code de la commune", "Libellé de la commune"),
) -> DataFrame:
    """Wide station rows summed to wide commune rows.

    Counts and votes are added (half-even whole numbers), the other columns
    keep their first value in file order, and the percentages are recomputed.
    The commune code is part of the key: communes that share a name stay apart.
    ``keys=("Libellé de la commune",)`` groups by name alone.
    """
    slots = slot_count(bronze.columns, ("Voix",))
    votes = [f"Voix_{k}" for k in range(1, slots + 1)]
    sums = [*L.COUNT_FIELDS, *votes]
    areas = ("Code du département", "Libellé du département", "Code de la circonscription",
             "Libellé de la circonscription", "Code de la commune", "Libellé de la commune")
    firsts = [c for c in areas if c in bronze.columns and c not in keys]
    firsts += [f"{f}_{k}" for k in range(1, slots + 1) for f in ("N°Panneau", "Sexe", "Nom", "Prénom")]
    order = F.col(order) if isinstance(order, str) else order
    numbers = {c: to_double(decimal_point(F.col(f"`{c}`"))) for c in sums}
    rows = bronze.withColumn("row_order", order).withColumns(numbers)
    grouped = first_and_sum(rows, keys, firsts, sums, "row_order").withColumns(
        {c: whole(F.col(c)) for c in sums}
    )
    bases = {"Ins": "Inscrits", "Vot": "Votants", "Exp": "Exprimés"}
    turnout = {"Abs": "Abstentions", "Vot": "Votants", "Blancs": "Blancs", "Nuls": "Nuls", "Exp": "Exprimés"}
    shares = {
        f"% {short}/{base}": pct(F.col(count), F.col(bases[base]))
        for short, count in turnout.items()
        for base in ("Ins", "Vot")
        if f"% {short}/{base}" in L.STATION_FIELDS
    }
    shares |= {
        f"% Voix/{base}_{k}": pct(F.col(f"Voix_{k}"), F.col(bases[base]))
        for k in range(1, slots + 1)
        for base in ("Ins", "Exp")
    }
    return grouped.withColumns(shares)


def versus(df: DataFrame, votes: str, rival_votes: str, name: str) -> DataFrame:
    """Votes relative to the main competitor, two digits; NULL without rival votes."""
    ratio = F.try_divide(F.col(votes).cast("double"), F.col(rival_votes).cast("double"))
    return df.withColumn(name, half_even(ratio))


def commune_units(votes: DataFrame) -> DataFrame:
    """The communes of each election as units of a crosswalk: (period, area, key, name, size).

    A period is the year and the round (``20171``), the size the registered
    voters; silver votes repeat both per candidate.
    """
    period = (F.col("annee_election") * 10 + F.col("tour")).cast("int").alias("period")
    return votes.groupBy(
        period, F.col("code_departement").alias("area"), F.col("code_commune").alias("key")
    ).agg(F.max("libelle_commune").alias("name"), F.max("inscrits").cast("long").alias("size"))
