"""Layouts of the source files and of the conformed tables."""

from __future__ import annotations

# Result files of the French presidential elections, in file
# order, with the conformed name and type of each column that silver keeps.
AREA_FIELDS = {
    "Code du département": "code_departement",
    "Libellé du département": "libelle_departement",
    "Code de la commune": "code_commune",
    "Libellé de la commune": "libelle_commune",
}
STATION_FIELDS = (
    "Code du département", "Libellé du département",
    "Code de la circonscription", "Libellé de la circonscription",
    "Code de la commune", "Libellé de la commune",
    "Code du b.vote", "Inscrits", "Abstentions", "% Abs/Ins",
    "Votants", "% Vot/Ins", "Blancs", "% Blancs/Ins", "% Blancs/Vot",
    "Nuls", "% Nuls/Ins", "% Nuls/Vot", "Exprimés", "% Exp/Ins", "% Exp/Vot",
)
CANDIDATE_FIELDS = ("N°Panneau", "Sexe", "Nom", "Prénom", "Voix", "% Voix/Ins", "% Voix/Exp")

# Counts of a polling station.
COUNT_FIELDS = {
    "Inscrits": "inscrits",
    "Abstentions": "abstentions",
    "Votants": "votants",
    "Blancs": "blancs",
    "Nuls": "nuls",
    "Exprimés": "exprimes",
}

# The slot fields that become columns of a candidate row.
SLOT_FIELDS = {
    "N°Panneau": "numero_panneau",
    "Sexe": "sexe",
    "Nom": "nom",
    "Prénom": "prenom",
    "Voix": "voix",
}

# Share column -> (numerator, denominator, zero-safe).
TURNOUT_SHARES = {
    "pct_abs_ins": ("abstentions", "inscrits", False),
    "pct_vot_ins": ("votants", "inscrits", False),
    "pct_blancs_ins": ("blancs", "inscrits", False),
    "pct_blancs_vot": ("blancs", "votants", True),
    "pct_nuls_ins": ("nuls", "inscrits", False),
    "pct_nuls_vot": ("nuls", "votants", True),
    "pct_exprimes_ins": ("exprimes", "inscrits", False),
    "pct_exprimes_vot": ("exprimes", "votants", True),
}
VOTE_SHARES = {
    "pct_voix_ins": ("voix", "inscrits", False),
    "pct_voix_exprimes": ("voix", "exprimes", True),
}

ELECTION_KEYS = ("annee_election", "tour")
COUNTS = tuple(COUNT_FIELDS.values())
CANDIDATE_KEYS = ("nom", "prenom", "sexe", "nuance")
VOTE_MEASURES = (*COUNTS, *TURNOUT_SHARES, "voix", *VOTE_SHARES)

# Columns of the conformed vote table, in order.
SILVER_VOTES = (
    *AREA_FIELDS.values(), *ELECTION_KEYS, *COUNTS, *TURNOUT_SHARES,
    "numero_panneau", "sexe", "nom", "prenom", "voix", *VOTE_SHARES,
    "nuance", "source_dataset", "date_refresh",
)

# Safety file column -> conformed column.
SAFETY_FIELDS = {
    "CODGEO_2025": "code_insee_commune",
    "annee": "annee",
    "indicateur": "indicateur",
    "unite_de_compte": "unite_de_compte",
    "nombre": "nombre",
    "taux_pour_mille": "taux_pour_mille",
    "est_diffuse": "est_diffuse",
    "insee_pop": "insee_pop",
    "insee_pop_millesime": "insee_pop_millesime",
    "insee_log": "insee_log",
    "insee_log_millesime": "insee_log_millesime",
    "complement_info_nombre": "complement_info_nombre",
    "complement_info_taux": "complement_info_taux",
    "timestamp_processing": "source_dataset_timestamp",
    "bronze_load_date": "date_refresh",
}
SAFETY_NUMBERS = (
    "nombre", "taux_pour_mille", "insee_pop", "insee_log",
    "complement_info_nombre", "complement_info_taux",
)
SAFETY_DATES = (
    "insee_pop_millesime", "insee_log_millesime", "source_dataset_timestamp", "date_refresh",
)
SILVER_SAFETY = (
    "code_departement", "code_commune", "code_insee_commune", "annee", "indicateur",
    "unite_de_compte", "nombre", "taux_pour_mille", "est_diffuse", "insee_pop",
    "insee_pop_millesime", "insee_log", "insee_log_millesime",
    "complement_info_nombre", "complement_info_taux", "source_dataset",
    "source_dataset_timestamp", "date_refresh",
)
FACT_SAFETY = (
    "id_commune", "annee", "id_indicateur_securite", "code_departement", "code_commune",
    "code_insee_commune", "nombre", "taux_pour_mille", "est_diffuse", "insee_pop",
    "insee_log", "complement_info_nombre", "complement_info_taux", "source_dataset",
    "source_dataset_timestamp", "date_refresh",
)

# Measures of an election that become features of a commune.
FEATURE_METRICS = (
    "inscrits", "abstentions", "votants", "blancs", "nuls", "exprimes",
    "pct_abs_ins", "pct_vot_ins", "pct_blancs_ins", "pct_nuls_ins",
)
