"""Feature tables: one row per commune from the star facts."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from canton.functions import (
    commune_id, double_columns, election_label, slugify, to_double, to_long,
)
from canton.functions.text import sql_name
from canton.operators.aggregates import duel_label
from canton.operators.dimensions import require_key
from canton.operators.shaping import column_values
from canton.plans import layouts as L
from canton.session import stored_table


def wide_features(
    df: DataFrame, keys: Sequence[str], features: Mapping[str, str]
) -> DataFrame:
    """One column per feature from SQL expressions that are NULL off their rows.

    A feature that no row of the key provides stays NULL. One shuffle.
    """
    return df.groupBy(*keys).agg(*[F.expr(f"max({e}) AS {sql_name(name)}") for name, e in features.items()])


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def labelled_facts(
    facts: DataFrame, dim_election: DataFrame, dim_candidat: DataFrame
) -> DataFrame:
    """Vote facts with election label, candidate name and canonical commune key.

    A fact with an unknown election or candidate fails the job. The dimensions'
    labels are stored first: derived ones would be estimated, and joined, as if
    they had the facts' size.
    """
    elections = stored_table(
        dim_election.select(
            "id_election", election_label(F.col("annee_election"), F.col("tour")).alias("election")
        ),
        "elections",
    )
    candidates = stored_table(dim_candidat.select("id_candidat", "nom"), "candidates")
    df = require_key(facts, elections, ["id_election"], "election")
    df = require_key(df, candidates, ["id_candidat"], "nom")
    return df.withColumn("id_commune", commune_id(F.col("id_commune")))


def election_features(
    facts: DataFrame,
    exclude: Collection[str] = (),
    names: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Turnout metrics per election and vote share per election and candidate.

    ``facts`` comes from ``labelled_facts``. ``exclude`` lists election labels
    whose results must not be features. ``names`` are the (candidate slug,
    election) pairs, discovered from the data when absent. A blank number
    counts as 0; only an absent row leaves NULL.
    """
    rows = facts.where(~F.col("election").isin(list(exclude))) if exclude else facts
    # A few columns per (commune, election, candidate), compiled; what is
    # pivoted afterwards is small and holds each name once.
    typed = rows.select(
        "id_commune", "election", "nom",
        *double_columns(rows, ("pct_voix_exprimes", *L.FEATURE_METRICS), 0.0),
    )
    narrow = typed.groupBy("id_commune", "election", "nom").agg(
        *[F.max(c).alias(c) for c in ("pct_voix_exprimes", *L.FEATURE_METRICS)]
    )
    narrow = stored_table(narrow.withColumn("slug", slugify(F.col("nom"))), "election-features")
    if names is None:
        names = column_values(narrow, "slug", "election")
    features: dict[str, str] = {}
    for election in sorted({e for _, e in names}):
        for metric in L.FEATURE_METRICS:
            features[f"{metric}_{election.lower()}"] = (
                f"CASE WHEN election = {_text(election)} THEN {metric} END"
            )
    for name, election in names:
        features[f"share_{name}_{election.lower()}"] = (
            f"CASE WHEN election = {_text(election)} AND slug = {_text(name)} THEN pct_voix_exprimes END"
        )
    return wide_features(narrow, ["id_commune"], features)


def safety_features(
    facts: DataFrame,
    dim_indicateur: DataFrame,
    years: Sequence[int] = (2021, 2022),
    slugs: Sequence[str] | None = None,
) -> DataFrame:
    """Indicator rates, population and housing per year."""
    rows = facts.withColumn("year", to_long(F.col("annee"), 0)).where(F.col("year").isin(list(years)))
    dim = stored_table(
        dim_indicateur.select("id_indicateur_securite", slugify(F.col("indicateur")).alias("slug")),
        "indicators",
    )
    rows = require_key(rows, dim, ["id_indicateur_securite"], "slug")
    if slugs is None:
        slugs = column_values(dim, "slug")
    rows = rows.select(
        commune_id(F.col("id_commune")).alias("id_commune"),
        "year",
        "slug",
        *double_columns(rows, ("taux_pour_mille", "insee_pop", "insee_log"), 0.0),
    )
    features: dict[str, str] = {}
    for year in years:
        for s in slugs:
            features[f"sec_rate_{s}_{year}"] = (
                f"CASE WHEN year = {year} AND slug = {_text(s)} THEN taux_pour_mille END"
            )
        for c in ("insee_pop", "insee_log"):
            features[f"{c}_{year}"] = f"CASE WHEN year = {year} THEN {c} END"
    return wide_features(rows, ["id_commune"], features)


def _entry(name, value: str):
    return F.struct(name.alias("feature"), F.col(value).alias("value"))


def _long(rows: DataFrame, *entries) -> DataFrame:
    """(id_commune, feature, value) from entries per row; the largest value of a repeated feature."""
    narrow = rows.select("id_commune", F.inline(F.array(*entries)))
    return narrow.groupBy("id_commune", "feature").agg(F.max("value").alias("value"))


def election_rows(facts: DataFrame, exclude: Collection[str] = ()) -> DataFrame:
    """``election_features`` in long form: a row per value, any number of names.

    Turnout metrics are named ``<metric>_<election>``, vote shares
    ``share_<candidate slug>_<election>``. One shuffle, of pre-aggregated rows.
    """
    rows = facts.where(~F.col("election").isin(list(exclude))) if exclude else facts
    typed = rows.select(
        "id_commune",
        F.lower("election").alias("ending"),
        slugify(F.col("nom")).alias("slug"),
        *double_columns(rows, ("pct_voix_exprimes", *L.FEATURE_METRICS), 0.0),
    )
    share = F.concat_ws("_", F.lit("share"), F.nullif("slug", F.lit("")), "ending")
    return _long(
        typed,
        _entry(F.when(F.col("slug").isNotNull(), share), "pct_voix_exprimes"),
        *[_entry(F.concat_ws("_", F.lit(m), "ending"), m) for m in L.FEATURE_METRICS],
    ).where("feature IS NOT NULL")


def safety_rows(
    facts: DataFrame, dim_indicateur: DataFrame, years: Sequence[int] = (2021, 2022)
) -> DataFrame:
    """``safety_features`` in long form."""
    rows = facts.withColumn("year", to_long(F.col("annee"), 0)).where(F.col("year").isin(list(years)))
    dim = stored_table(
        dim_indicateur.select("id_indicateur_securite", slugify(F.col("indicateur")).alias("slug")),
        "indicators",
    )
    rows = require_key(rows, dim, ["id_indicateur_securite"], "slug")
    typed = rows.select(
        commune_id(F.col("id_commune")).alias("id_commune"),
        F.col("year").cast("string").alias("ending"),
        "slug",
        *double_columns(rows, ("taux_pour_mille", "insee_pop", "insee_log"), 0.0),
    )
    return _long(
        typed,
        _entry(F.concat_ws("_", F.lit("sec_rate"), "slug", "ending"), "taux_pour_mille"),
        *[_entry(F.concat_ws("_", F.lit(c), "ending"), c) for c in ("insee_pop", "insee_log")],
    )


def assemble(targets: DataFrame, *frames: DataFrame, key: str = "id_commune") -> DataFrame:
    """Labelled communes with all features, feature columns in sorted order.

    Every input is aggregated by ``key``, so the joins reuse that partitioning.
    """
    joined = reduce(lambda a, b: a.join(b, key, "left"), frames, targets)
    names = sorted(set(joined.columns) - set(targets.columns))
    return joined.select(*map(sql_name, [*targets.columns, *names]))


def commune_labels(
    facts: DataFrame, election: str, winner: str, loser: str, name: str
) -> DataFrame:
    """1 where ``winner`` beats ``loser`` in ``election``, ties and losses 0."""
    rows = facts.where(F.col("election") == election).withColumn(
        "voix", to_double(F.col("voix"), 0.0)
    )
    return duel_label(rows, ["id_commune"], "nom", "voix", winner, loser, name)
