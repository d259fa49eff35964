"""Public-safety indicators: bronze text to the silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from canton.functions import strip, timestamp_or_null, to_double, year_of, zfill
from canton.operators.shaping import pivot_sum, stripped_names
from canton.plans import layouts as L


def conform_safety(bronze: DataFrame, source_dataset: str = "securite_commune") -> DataFrame:
    """Split area code, typed numbers and dates, in the silver order."""
    df = stripped_names(bronze)
    df = df.select(
        *[strip(F.col(f"`{src}`")).alias(out) for src, out in L.SAFETY_FIELDS.items()]
    )
    code = zfill(F.col("code_insee_commune"), 5)
    typed = {
        "code_insee_commune": code,
        "code_departement": F.substring(code, 1, 2),
        "code_commune": F.substr(code, F.lit(3)),
        "annee": year_of(F.col("annee")),
        "source_dataset": F.lit(source_dataset),
        **{c: timestamp_or_null(F.col(c)) for c in L.SAFETY_DATES},
        **{c: to_double(F.col(c)) for c in L.SAFETY_NUMBERS},
    }
    return df.select(*[typed.get(c, F.col(c)).alias(c) for c in L.SILVER_SAFETY])


def wide_safety(silver: DataFrame, indicators: list[str] | None = None) -> DataFrame:
    """One row per commune, year and population; one rate column per indicator."""
    index = ["code_departement", "code_commune", "code_insee_commune", "annee", "insee_pop"]
    return pivot_sum(silver, index, "indicateur", "taux_pour_mille", indicators, blank_as_zero=True)
