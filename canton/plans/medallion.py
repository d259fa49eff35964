"""The whole flow over stored tables: bronze, silver, gold, quality, model.

Each stage writes Parquet and the next one reads it, so a stage can be rerun
alone, lost executors only repeat their tasks, and later scans read only the
columns they need.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from canton.operators.quality import (
    Rule, cascade, ceiling_check, checked_write, enforce, join_reports, merged_reports, not_negative,
    reference_check, row_checks, unique_check, within_percent,
)
from canton.operators.shaping import (
    check_arity, filter_area, find_column, repair_slot_header, stripped_names,
)
from canton.plans import layouts as L
from canton.plans.experiment import (
    Experiment, VectorExperiment, ablation, comparison, comparison_document, vector_ablation,
)
from canton.plans.features import (
    assemble, commune_labels, election_features, election_rows, labelled_facts, safety_features, safety_rows,
)
from canton.plans.safety import conform_safety, wide_safety
from canton.plans.stars import SafetyStar, VoteStar, build_safety_star, build_star
from canton.plans.votes import silver_votes, stations_to_communes
from canton.sources.delimited import file_order, read_delimited, read_wide_votes, sniff_delimiter
from canton.sources.sinks import export_json, read_table, with_audit, write_table
from canton.sources.workbooks import read_workbooks
from canton.session import durable, stored_table

DEPARTMENT_WORDS = ("département", "departement", "dept")


@dataclass(frozen=True)
class VoteSource:
    """One landed result file (or a glob of its parts).

    ``slots`` is the number of candidates of a text file; a workbook tells it
    by its header. ``header`` says whether a text file starts with a header
    line that must be skipped. ``by_commune`` sums the stations in bronze.
    """

    path: str
    url: str
    year: int
    round: int
    kind: str = "text"
    slots: int = 0
    header: bool = True
    by_commune: bool = False

    @property
    def name(self) -> str:
        return f"{self.year}_T{self.round}"


def bronze_votes(
    spark: SparkSession, source: VoteSource, area: str, ingested_at: str | None = None
) -> DataFrame:
    """The rows of one area with repaired slot names and audit columns."""
    if source.kind == "workbook":
        rows = read_workbooks(spark, source.path, keep_path=True)
        body = [c for c in rows.columns if c not in ("path", "sheet_row")]
        names = [c.strip() for c in repair_slot_header(body, L.CANDIDATE_FIELDS)]
        df = check_arity(rows, ["path", "sheet_row", *names])
        order = F.struct("path", "sheet_row")
        file_name = F.substring_index("path", "/", -1)
    else:
        df = read_wide_votes(
            spark, source.path, L.STATION_FIELDS, L.CANDIDATE_FIELDS, source.slots, header=source.header
        )
        order, file_name = file_order(), F.col("_metadata.file_name")
    df = df.withColumns({"source_order": order, "source_name": file_name})
    df = filter_area(df, find_column(df, DEPARTMENT_WORDS), area)
    if source.by_commune:
        names = df.groupBy("Code de la commune", "Libellé de la commune").agg(
            F.min("source_name").alias("source_name")
        )
        df = stations_to_communes(df, "source_order").join(
            names, ["Code de la commune", "Libellé de la commune"], "left"
        )
    audited = with_audit(df, source.url, ingested_at, F.col("source_name"))
    return audited.drop("path", "sheet_row", "source_order", "source_name")


def bronze_reference(
    spark: SparkSession,
    path: str,
    url: str,
    area_column: str | None = None,
    area: str | None = None,
    ingested_at: str | None = None,
) -> DataFrame:
    """A small code list with unknown separator, optionally one area of it."""
    df = stripped_names(read_delimited(spark, path, sep=sniff_delimiter(spark, path)))
    if area_column is not None:
        df = filter_area(df, area_column, area, conform=False)
    return with_audit(df, url, ingested_at)


def vote_rules() -> list[Rule]:
    """The agreed row-level rules of a silver vote table."""
    shares = [within_percent(c) for c in (*L.TURNOUT_SHARES, *L.VOTE_SHARES)]
    counts = [not_negative(c) for c in (*L.COUNTS, "voix")]
    return [cascade("inscrits", "votants", "exprimes"), *shares, *counts]


def vote_report(silver: DataFrame, star: VoteStar, row_report: DataFrame | None = None) -> DataFrame:
    """The agreed checks on a vote table and its star.

    ``row_report`` holds the row-level rules where they were counted while
    ``silver`` was written.
    """
    commune = ["code_departement", "code_commune", "libelle_commune", *L.ELECTION_KEYS]
    rows = row_checks(silver, vote_rules()) if row_report is None else row_report
    return join_reports(
        rows,
        ceiling_check(silver, commune, "voix", "exprimes", "voix_le_exprimes"),
        unique_check(star.dim_commune, ["id_commune"], "dim_commune_unique"),
        unique_check(star.dim_election, ["id_election"], "dim_election_unique"),
        reference_check(star.fact_resultats, star.dim_candidat, ["id_candidat"], "fact_has_candidat"),
        reference_check(star.fact_resultats, star.dim_commune, ["id_commune"], "fact_has_commune"),
    )


def build_votes(
    spark: SparkSession,
    sources: Sequence[VoteSource],
    reference: DataFrame,
    reference_on: dict[str, str],
    area: str,
    out: str,
    loaded_at: str | None = None,
    reference_order: Column | str | None = None,
) -> VoteStar:
    """All result files to a stored, checked vote star.

    Files have their own slot counts, so each gets its bronze and silver
    folder; the star reads all silver folders at once. Of repeated reference
    rows the first in the file counts, or in ``reference_order``. The star is
    staged, what was staged is checked, and only then published: critical
    quality failures stop the run after the report is written.
    """
    checked = []
    for source in sources:
        bronze, silver = (f"{out}/{layer}/votes/{source.name}" for layer in ("bronze", "silver"))
        write_table(bronze_votes(spark, source, area, loaded_at), bronze)
        rows = silver_votes(
            read_table(spark, bronze), reference, source.name, (source.year, source.round),
            loaded_at, reference_on, order=reference_order,
        )
        checked.append(checked_write(rows, silver, vote_rules()))
    votes = read_table(spark, [f"{out}/silver/votes/{s.name}" for s in sources])
    build_star(votes, loaded_at).save(f"{out}/staging/votes")
    star = _stored_star(spark, f"{out}/staging/votes")
    report = durable(vote_report(votes, star, merged_reports(*checked)))
    export_json(report, f"{out}/quality/votes")
    enforce(report)
    star.save(f"{out}/gold/votes")
    return _stored_star(spark, f"{out}/gold/votes")


def _stored_star(spark: SparkSession, path: str) -> VoteStar:
    return VoteStar(**{n: read_table(spark, f"{path}/{n}") for n in VoteStar.PARTS})


def build_safety(spark: SparkSession, path: str, out: str) -> SafetyStar:
    """An all-text indicator file to its silver table, wide table and star."""
    write_table(conform_safety(read_delimited(spark, path)), f"{out}/silver/safety")
    silver = read_table(spark, f"{out}/silver/safety")
    write_table(wide_safety(silver), f"{out}/gold/dim_securite")
    build_safety_star(silver).save(f"{out}/gold/safety")
    return SafetyStar(**{n: read_table(spark, f"{out}/gold/safety/{n}") for n in SafetyStar.PARTS})


def build_model(
    votes: VoteStar,
    safety: SafetyStar,
    out: str,
    target: str = "2022_T2",
    optional: str = "2022_T1",
    winner: str = "MACRON",
    loser: str = "LE PEN",
    label: str = "target_macron_wins_2022_t2",
    years: Sequence[int] = (2021, 2022),
    vectors: bool = False,
    **fit,
) -> list[Experiment] | list[VectorExperiment]:
    """Features, label and the two experiments with and without ``optional``.

    The feature table is computed and stored once; the second experiment only
    leaves columns out. With ``vectors`` that table stays in long form, and
    the experiments run on sparse vectors: for more candidates and elections
    than a table should have columns.
    """
    facts = stored_table(
        labelled_facts(votes.fact_resultats, votes.dim_election, votes.dim_candidat).select(
            "id_commune", "election", "nom", "voix", "pct_voix_exprimes", *L.FEATURE_METRICS
        ),
        "labelled-facts",
    )
    labels = commune_labels(facts, target, winner, loser, label)
    ending = f"_{optional.lower()}"
    if vectors:
        long = election_rows(facts, exclude=[target]).unionByName(
            safety_rows(safety.fact_securite, safety.dim_indicateur_securite, years)
        )
        write_table(long, f"{out}/model/feature_rows")
        sets = {f"with{ending}": None, f"without{ending}": ~F.col("feature").endswith(ending)}
        rows = read_table(long.sparkSession, f"{out}/model/feature_rows")
        return _saved(vector_ablation(labels, rows, sets, label, "id_commune", **fit), out)
    dataset = assemble(
        labels,
        election_features(facts, exclude=[target]),
        safety_features(safety.fact_securite, safety.dim_indicateur_securite, years),
    )
    write_table(dataset, f"{out}/model/dataset")
    stored = read_table(dataset.sparkSession, f"{out}/model/dataset")
    names = [c for c in stored.columns if c not in ("id_commune", label)]
    runs = ablation(
        stored,
        {
            f"with{ending}": names,
            f"without{ending}": [n for n in names if not n.endswith(ending)],
        },
        label,
        "id_commune",
        **fit,
    )
    return _saved(runs, out)


def _saved(runs: list, out: str) -> list:
    for run in runs:
        run.save(f"{out}/model")
    export_json(comparison(runs), f"{out}/model/comparison")
    export_json(comparison_document(runs), f"{out}/model/comparison_metrics")
    return runs
