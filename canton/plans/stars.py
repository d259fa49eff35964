"""Star schemas for votes and for public safety."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from canton.functions import (
    composite_key, election_label, iso_text, strip, timestamp_or_null, to_double, to_long, zfill,
)
from canton.operators.aggregates import keep_latest
from canton.operators.dimensions import lookup_key, members, surrogate_key
from canton.plans import layouts as L
from canton.session import stored_table
from canton.sources.sinks import write_table

_AREAS = ("code_departement", "libelle_departement", "code_commune", "libelle_commune")


class _Star:
    """Tables by name. A part is given, or built when it is first asked for."""

    PARTS: tuple[str, ...] = ()

    def __init__(self, **parts: DataFrame):
        self.__dict__.update(parts)


class VoteStar(_Star):
    PARTS = ("dim_election", "dim_commune", "commune_history", "dim_candidat", "fact_resultats")

    dim_election: DataFrame
    dim_commune: DataFrame
    commune_history: DataFrame
    dim_candidat: DataFrame
    fact_resultats: DataFrame

    def save(self, path: str) -> None:
        for name in ("dim_election", "dim_commune", "commune_history", "dim_candidat"):
            write_table(getattr(self, name), f"{path}/{name}")
        write_table(self.fact_resultats, f"{path}/fact_resultats", partition_by=["id_election"])


class SafetyStar(_Star):
    PARTS = ("dim_indicateur_securite", "fact_securite")

    dim_indicateur_securite: DataFrame
    fact_securite: DataFrame

    def save(self, path: str) -> None:
        write_table(self.dim_indicateur_securite, f"{path}/dim_indicateur_securite")
        write_table(
            self.fact_securite, f"{path}/fact_securite", partition_by=["annee"],
            sort_by=["code_departement", "code_commune", "id_indicateur_securite"],
        )


def _commune_key():
    return composite_key(F.col("code_departement"), F.col("code_commune"))


class _BuiltVoteStar(VoteStar):
    def __init__(self, votes: DataFrame, loaded_at: str | None):
        super().__init__()
        self._votes, self._loaded_at = votes, loaded_at

    @cached_property
    def dim_election(self) -> DataFrame:
        return members(self._votes, L.ELECTION_KEYS).select(
            election_label(F.col("annee_election"), F.col("tour")).alias("id_election"),
            *L.ELECTION_KEYS,
        )

    @cached_property
    def commune_history(self) -> DataFrame:
        return (
            self._votes.groupBy(*_AREAS)
            .agg(
                F.min("annee_election").alias("first_year"),
                F.max("annee_election").alias("last_year"),
            )
            .select(_commune_key().alias("id_commune"), *_AREAS, "first_year", "last_year")
        )

    @cached_property
    def dim_commune(self) -> DataFrame:
        history = keep_latest(self.commune_history, ["id_commune"], ["last_year"])
        return history.select("id_commune", *_AREAS)

    @cached_property
    def dim_candidat(self) -> DataFrame:
        keyed = surrogate_key(self._votes, L.CANDIDATE_KEYS, "id_candidat", "CAND_")
        return stored_table(keyed, "dim-candidat")

    @cached_property
    def fact_resultats(self) -> DataFrame:
        loaded_at = self._loaded_at
        stamp = F.lit(loaded_at) if loaded_at else iso_text(F.current_timestamp(), micros=True)
        return lookup_key(self._votes, self.dim_candidat, L.CANDIDATE_KEYS).select(
            _commune_key().alias("id_commune"),
            election_label(F.col("annee_election"), F.col("tour")).alias("id_election"),
            "id_candidat",
            *L.VOTE_MEASURES,
            stamp.alias("date_integration_gold"),
        )


def build_star(votes: DataFrame, loaded_at: str | None = None) -> VoteStar:
    """Dimensions and facts of a silver vote table, each built on demand.

    ``dim_commune`` has one row per key, with the label of the latest election:
    communes that changed their name would otherwise double their facts. All
    labels remain in ``commune_history`` with their first and last year.
    """
    return _BuiltVoteStar(votes, loaded_at)


def conform_safety_facts(silver: DataFrame) -> DataFrame:
    """Silver safety rows re-typed for gold; also accepts the all-text export."""
    typed = {
        "code_departement": zfill(strip(F.col("code_departement").cast("string")), 2),
        "code_commune": zfill(strip(F.col("code_commune").cast("string")), 3),
        "code_insee_commune": zfill(strip(F.col("code_insee_commune").cast("string")), 5),
        "annee": to_long(F.col("annee")).cast("int"),
        "insee_pop": to_long(F.col("insee_pop")),
        "insee_log": to_long(F.col("insee_log")),
        **{c: strip(F.col(c)) for c in ("indicateur", "unite_de_compte", "est_diffuse", "source_dataset")},
        **{c: timestamp_or_null(F.col(c).cast("string")) for c in ("source_dataset_timestamp", "date_refresh")},
        **{c: to_double(F.col(c)) for c in ("nombre", "taux_pour_mille", "complement_info_nombre", "complement_info_taux")},
    }
    kept = silver.select(*[c.alias(n) for n, c in typed.items()])
    return kept.withColumn("id_commune", _commune_key())


def build_safety_star(silver: DataFrame) -> SafetyStar:
    rows = conform_safety_facts(silver)
    keys = ["indicateur", "unite_de_compte"]
    dim = stored_table(surrogate_key(rows, keys, "id_indicateur_securite", "SEC_"), "dim-indicateur")
    facts = lookup_key(rows, dim, keys).select(*L.FACT_SAFETY)
    return SafetyStar(dim_indicateur_securite=dim, fact_securite=facts)
