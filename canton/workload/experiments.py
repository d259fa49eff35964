"""Splits, scaling, metrics, feature tables and model experiments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from canton.functions import half_even
from canton.operators.aggregates import class_balance
from canton.operators.metrics import classification_metrics, majority_class
from canton.operators.scaling import impute_scale
from canton.operators.split import stratified_split
from canton.plans import layouts as L
from canton.operators.sparse import feature_dictionary, scaled_entries, sparse_vectors, with_vectors
from canton.plans.experiment import (
    ablation, comparison, comparison_document, metrics_document, vector_ablation,
)
from canton.plans.features import (
    assemble, commune_labels, election_features, election_rows, labelled_facts, safety_features, safety_rows,
)
from canton.plans.stars import build_safety_star, build_star
from canton.session import scratch_path, stored_table
from canton.sources.sinks import export_json
from canton.workload.registry import query, table
from canton.workload.stars import SAFETY_SQL, safety_table
from canton.workload.votes import SILVER_SQL, SLOTS, silver_table


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = stratified_split(table(spark, sf_dir, "labels"), "quality", "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


_SPLIT_SQL = """
    ranked AS (SELECT doc_id, quality, toxic, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id)) AS place,
                      count(*) OVER (PARTITION BY quality) AS n FROM labels WHERE quality IS NOT NULL),
    parts AS (SELECT doc_id, quality, toxic,
                     CASE WHEN place <= greatest(1, round_even(n * (1 - CAST(0.2 AS DOUBLE)), 0)) THEN 'train' ELSE 'test' END AS part FROM ranked)
"""


@query("stratified_split", f"WITH {_SPLIT_SQL} SELECT doc_id, quality, toxic, part FROM parts")
def stratified_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir)


@query(
    "class_balance",
    f"WITH {_SPLIT_SQL} SELECT part || '_' || quality AS part_class, count(*) AS n_rows FROM parts GROUP BY ALL",
)
def class_balance_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _parts(spark, sf_dir).withColumn("part_class", F.concat_ws("_", "part", "quality"))
    return class_balance(named, "part_class")


def _document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("n_chars") >= 300, F.col("n_chars"))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", size.alias("size"), F.lit(7).alias("constant"),
        F.when(F.col("lang") == "xx", 1.0).alias("absent"),
        (F.col("lang") == "en").cast("int").alias("english"),
    )
    return table(spark, sf_dir, "labels").join(documents, "doc_id", "left")


@query(
    "impute_scale",
    f"""
    WITH {_SPLIT_SQL},
    f AS (SELECT p.doc_id, p.part, CASE WHEN n_chars >= 300 THEN n_chars END AS size,
                 CAST(lang = 'en' AS INTEGER) AS english FROM parts p LEFT JOIN documents d ON p.doc_id = d.doc_id),
    s AS (SELECT avg(size) AS size_mean, stddev_pop(size) AS size_std, avg(english) AS en_mean, stddev_pop(english) AS en_std
          FROM f WHERE part = 'train')
    SELECT doc_id, part, round_even((coalesce(size, size_mean) - size_mean) / size_std * 1000000, 0) / 1000000 AS size,
           round_even((coalesce(english, en_mean) - en_mean) / en_std * 1000000, 0) / 1000000 AS english,
           CAST(0 AS DOUBLE) AS constant, CAST(0 AS DOUBLE) AS absent
    FROM f, s
    """,
)
def impute_scale_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["size", "english", "constant", "absent"]
    train, test = stratified_split(_document_features(spark, sf_dir), "quality", "doc_id")
    train, test = impute_scale(train, test, columns=columns)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("doc_id", "part", *[half_even(F.col(c), 6).alias(c) for c in columns])


def _ratio_sql(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END"


_METRIC_SQL = f"""
    counts AS (SELECT scored, lang, count(*) FILTER (WHERE quality = 1 AND p = 1) AS tp, count(*) FILTER (WHERE quality = 0 AND p = 0) AS tn,
                      count(*) FILTER (WHERE quality = 0 AND p = 1) AS fp, count(*) FILTER (WHERE quality = 1 AND p = 0) AS fn
               FROM scored_rows GROUP BY ALL),
    shares AS (SELECT *, {_ratio_sql('tp', 'tp + fp')} AS precision, {_ratio_sql('tp', 'tp + fn')} AS recall,
                      {_ratio_sql('tn', 'tn + fp')} AS specificity, {_ratio_sql('tp + tn', 'tp + tn + fp + fn')} AS accuracy FROM counts)
    SELECT scored, lang, accuracy, (recall + specificity) / 2 AS balanced_accuracy, precision, recall, specificity,
           {_ratio_sql('2 * precision * recall', 'precision + recall')} AS f1, tp, tn, fp, fn
    FROM shares
"""


@query(
    "classification_metrics",
    f"""
    WITH base AS (SELECT doc_id, lang, quality, CASE WHEN toxic = 0 AND n_chars >= 300 THEN 1 ELSE 0 END AS rule
                  FROM labels JOIN documents USING (doc_id)),
    scored_rows AS (SELECT 'rule' AS scored, lang, quality, rule AS p FROM base
      UNION ALL SELECT 'majority', lang, quality, (SELECT CAST(round_even(avg(quality), 0) AS INTEGER) FROM base) FROM base),
    {_METRIC_SQL}
    """,
)
def classification_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    rows = table(spark, sf_dir, "labels").join(documents, "doc_id")
    rule = ((F.col("toxic") == 0) & (F.col("n_chars") >= 300)).cast("int")
    ruled = rows.select(F.lit("rule").alias("scored"), "lang", "quality", rule.alias("p"))
    base = rows.select(
        F.lit("majority").alias("scored"), "lang", "quality",
        F.lit(majority_class(rows, "quality")).alias("p"),
    )
    return classification_metrics(ruled.unionByName(base), "quality", "p", by=("scored", "lang"))


TARGET = "2000_T2"
LATER = (TARGET, "2001_T1", "2001_T2")
ELECTIONS = tuple(f"{y}_T{t}" for y in range(1995, 2001) for t in (1, 2) if f"{y}_T{t}" != TARGET)
_INDICATORS = tuple(f"{e}_d_ete" for e in ("click", "error", "purchase", "signup", "view"))


def _vote_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = build_star(silver_table(spark, sf_dir))
    return labelled_facts(star.fact_resultats, star.dim_election, star.dim_candidat)


def _election_columns() -> dict[str, str]:
    out = {}
    for e in ELECTIONS:
        for m in L.FEATURE_METRICS:
            out[f"{m}_{e.lower()}"] = f"max(CASE WHEN election = '{e}' THEN CAST({m} AS DOUBLE) END)"
        for k in range(1, SLOTS + 1):
            out[f"share_candidat_{k}_{e.lower()}"] = (
                f"max(CASE WHEN election = '{e}' AND numero_panneau = {k} THEN pct_voix_exprimes END)"
            )
    return out


def _safety_columns() -> dict[str, str]:
    out = {}
    for y in (2021, 2022):
        for s in _INDICATORS:
            event = s.split("_")[0].capitalize()
            out[f"sec_rate_{s}_{y}"] = (
                f"max(CASE WHEN annee = {y} AND indicateur = '{event} d''été' THEN coalesce(taux_pour_mille, 0) END)"
            )
        for c in ("insee_pop", "insee_log"):
            out[f"{c}_{y}"] = f"max(CASE WHEN annee = {y} THEN {c} END)"
    return out


def _columns_sql(columns: dict[str, str]) -> str:
    return ",\n".join(f"{v} AS {k}" for k, v in columns.items())


_FACTS_SQL = """
    facts AS (SELECT *, code_departement || '-' || code_commune AS id_commune, annee_election || '_T' || tour AS election FROM votes)
"""
_EF_SQL = f"""
    ef AS (SELECT id_commune, {_columns_sql(_election_columns())} FROM facts
           WHERE election NOT IN {LATER} GROUP BY id_commune)
"""
_SF_SQL = f"""
    sf AS (SELECT code_departement || '-' || code_commune AS id_commune, {_columns_sql(_safety_columns())}
           FROM safety WHERE annee IN (2021, 2022) GROUP BY ALL)
"""


@query("election_features", f"WITH {SILVER_SQL}, {_FACTS_SQL}, {_EF_SQL} SELECT * FROM ef")
def election_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return election_features(_vote_facts(spark, sf_dir), exclude=LATER)


def _safety_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = build_safety_star(safety_table(spark, sf_dir))
    return safety_features(star.fact_securite, star.dim_indicateur_securite)


@query("safety_features", f"WITH {SAFETY_SQL}, {_SF_SQL} SELECT * FROM sf")
def safety_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _safety_features(spark, sf_dir)


def model_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = stored_table(
        _vote_facts(spark, sf_dir).select(
            "id_commune", "election", "nom", "voix", "pct_voix_exprimes", *L.FEATURE_METRICS
        ),
        "labelled-facts",
    )
    targets = commune_labels(facts, TARGET, "CANDIDAT 1", "CANDIDAT 2", "first_wins")
    return assemble(
        targets, election_features(facts, exclude=LATER), _safety_features(spark, sf_dir)
    )


@query(
    "model_dataset",
    f"""
    WITH {SILVER_SQL}, {_FACTS_SQL}, {_EF_SQL}, {SAFETY_SQL}, {_SF_SQL},
    targets AS (SELECT id_commune, CAST(max(CASE WHEN numero_panneau = 1 THEN voix END) > max(CASE WHEN numero_panneau = 2 THEN voix END) AS INTEGER) AS first_wins
                FROM facts WHERE election = '{TARGET}' AND numero_panneau IN (1, 2) GROUP BY id_commune)
    SELECT * FROM targets LEFT JOIN ef USING (id_commune) LEFT JOIN sf USING (id_commune)
    """,
)
def model_dataset_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_dataset(spark, sf_dir)


def _labels_and_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The labelled communes and all features as long rows."""
    facts = stored_table(
        _vote_facts(spark, sf_dir).select(
            "id_commune", "election", "nom", "voix", "pct_voix_exprimes", *L.FEATURE_METRICS
        ),
        "labelled-facts",
    )
    star = build_safety_star(safety_table(spark, sf_dir))
    rows = election_rows(facts, exclude=LATER).unionByName(
        safety_rows(star.fact_securite, star.dim_indicateur_securite)
    )
    return commune_labels(facts, TARGET, "CANDIDAT 1", "CANDIDAT 2", "first_wins"), rows


_ROWS_SQL = f"""
    {SILVER_SQL}, {_FACTS_SQL}, {_EF_SQL}, {SAFETY_SQL}, {_SF_SQL},
    feature_rows AS (
      SELECT id_commune, feature, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (SELECT id_commune, CAST(COLUMNS(* EXCLUDE id_commune) AS DOUBLE) FROM ef) ON COLUMNS(* EXCLUDE id_commune) INTO NAME feature VALUE value)
      UNION ALL
      SELECT id_commune, feature, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (SELECT id_commune, CAST(COLUMNS(* EXCLUDE id_commune) AS DOUBLE) FROM sf) ON COLUMNS(* EXCLUDE id_commune) INTO NAME feature VALUE value)
    ),
    dictionary AS (
      SELECT feature, CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS index, count(value) AS n_rows,
             avg(value) AS mean, CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS deviation
      FROM feature_rows GROUP BY feature
    )
"""


def _sql_digits(x: str) -> str:
    return f"round_even(({x}) * 1000000, 0) / 1000000"


@query("feature_rows", f"WITH {_ROWS_SQL} SELECT * FROM feature_rows")
def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of all communes in long form: names are data."""
    return _labels_and_rows(spark, sf_dir)[1]


@query(
    "feature_dictionary",
    f"WITH {_ROWS_SQL} SELECT feature, index, n_rows, {_sql_digits('mean')} AS mean, {_sql_digits('deviation')} AS deviation FROM dictionary",
)
def feature_dictionary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = {c: half_even(F.col(c), 6) for c in ("mean", "deviation")}
    return feature_dictionary(_labels_and_rows(spark, sf_dir)[1]).withColumns(rounded)


@query(
    "feature_vectors",
    f"""
    WITH {_ROWS_SQL},
    targets AS (SELECT id_commune, CAST(max(CASE WHEN numero_panneau = 1 THEN voix END) > max(CASE WHEN numero_panneau = 2 THEN voix END) AS INTEGER) AS first_wins
                FROM facts WHERE election = '{TARGET}' AND numero_panneau IN (1, 2) GROUP BY id_commune)
    SELECT id_commune, first_wins, CAST(row_number() OVER (PARTITION BY id_commune ORDER BY index) - 1 AS INTEGER) AS place,
           index, {_sql_digits('(value - mean) / deviation')} AS value
    FROM targets JOIN feature_rows USING (id_commune) JOIN dictionary USING (feature)
    """,
)
def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled communes' sparse vectors, an entry a row."""
    labels, rows = _labels_and_rows(spark, sf_dir)
    rows = stored_table(rows, "feature-rows")
    vectors = sparse_vectors(scaled_entries(rows, feature_dictionary(rows), "id_commune"), "id_commune")
    entries = F.arrays_zip("indices", "values")
    return (
        with_vectors(labels, vectors, "id_commune")
        .select("id_commune", "first_wins", F.posexplode(entries).alias("place", "entry"))
        .select(
            "id_commune", "first_wins", "place", F.col("entry.indices").alias("index"),
            half_even(F.col("entry.values"), 6).alias("value"),
        )
    )


def _experiments(spark: SparkSession, sf_dir: str):
    labels, rows = _labels_and_rows(spark, sf_dir)
    sets = {"with_last_round": None, "without_last_round": ~F.col("feature").endswith("_2000_t1")}
    return vector_ablation(labels, rows, sets, "first_wins", "id_commune")


@query("logit_comparison")
def logit_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison(_experiments(spark, sf_dir))


@query("logit_metrics")
def logit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, map(metrics_document, _experiments(spark, sf_dir)))


def _document_experiment(spark: SparkSession, sf_dir: str):
    dataset = stored_table(_document_features(spark, sf_dir), "document-features")
    return ablation(dataset, _LOGIT_SETS, "quality", "doc_id")


_STEPS = 14  # Newton steps from zero: far more than the few that matter


def _newton_sql(name: str, features: list[str]) -> str:
    """CTEs ``{name}_s{k}``: the penalised likelihood's solution (w0 is the bias)."""
    n = len(features) + 1
    x = ["1.0", *features]
    state = ", ".join(f"CAST(0 AS DOUBLE) AS w{i}" for i in range(n))
    out = [f"{name}_s0 AS (SELECT {state})"]
    score = " + ".join(f"w{i} * {x[i]}" for i in range(n))
    for k in range(1, _STEPS + 1):
        ridge = ["0", *["0.001"] * (n - 1)]
        gradient = [f"avg((p - y) * {x[i]}) + {ridge[i]} * any_value(w{i}) AS g{i}" for i in range(n)]
        curve = [
            f"avg(p * (1 - p) * {x[i]} * {x[j]})" + (f" + {ridge[i]}" if i == j else "") + f" AS h{i}{j}"
            for i in range(n) for j in range(i, n)
        ]
        keep = [f"any_value(w{i}) AS w{i}" for i in range(n)]
        out.append(
            f"{name}_g{k} AS (SELECT {', '.join([*keep, *gradient, *curve])} FROM ("
            f"SELECT *, 1 / (1 + exp(-({score}))) AS p FROM train, {name}_s{k - 1}))"
        )
        if n == 2:
            det = "(h00 * h11 - h01 * h01)"
            steps = [f"(h11 * g0 - h01 * g1) / {det}", f"(h00 * g1 - h01 * g0) / {det}"]
        else:
            cofactor = {
                "00": "(h11 * h22 - h12 * h12)", "01": "(h02 * h12 - h01 * h22)", "02": "(h01 * h12 - h02 * h11)",
                "11": "(h00 * h22 - h02 * h02)", "12": "(h01 * h02 - h00 * h12)", "22": "(h00 * h11 - h01 * h01)",
            }
            det = f"(h00 * {cofactor['00']} + h01 * {cofactor['01']} + h02 * {cofactor['02']})"
            steps = [
                "(" + " + ".join(f"{cofactor[min(f'{i}{j}', f'{j}{i}')]} * g{j}" for j in range(3)) + f") / {det}"
                for i in range(3)
            ]
        new = ", ".join(f"w{i} - {s} AS w{i}" for i, s in enumerate(steps))
        out.append(f"{name}_s{k} AS (SELECT {new} FROM {name}_g{k})")
    return ",\n".join(out)


_LOGIT_SETS = {"size_and_language": ["size", "english"], "size_only": ["size"]}
_LOGIT_SQL = f"""
    WITH {_SPLIT_SQL},
    f AS (SELECT p.doc_id, p.part, p.quality, CASE WHEN n_chars >= 300 THEN n_chars END AS size,
                 CAST(lang = 'en' AS INTEGER) AS english FROM parts p LEFT JOIN documents d ON p.doc_id = d.doc_id),
    s AS (SELECT avg(size) AS size_mean, stddev_pop(size) AS size_std, avg(english) AS en_mean, stddev_pop(english) AS en_std
          FROM f WHERE part = 'train'),
    scaled AS (SELECT doc_id, part, quality, CAST(quality AS DOUBLE) AS y, (coalesce(size, size_mean) - size_mean) / size_std AS size,
                      (coalesce(english, en_mean) - en_mean) / en_std AS english FROM f, s),
    train AS (SELECT * FROM scaled WHERE part = 'train'),
    {",".join(_newton_sql(n, fs) for n, fs in _LOGIT_SETS.items())}
"""


def _sql_round(x: str) -> str:
    return f"round_even(({x}) * 10000, 0) / 10000"


def _predicted_sql(name: str, features: list[str]) -> str:
    score = " + ".join(["w0", *[f"w{i} * {f}" for i, f in enumerate(features, 1)]])
    p = f"1 / (1 + exp(-({score})))"
    return (
        f"SELECT '{name}' AS experiment, doc_id, quality, CAST({p} >= 0.5 AS INTEGER) AS predicted_class, "
        f"{_sql_round(p)} AS predicted_proba FROM scaled, {name}_s{_STEPS} WHERE part = 'test'"
    )


def _importance_sql(name: str, features: list[str]) -> str:
    rows = [
        f"SELECT '{name}' AS experiment, '{f}' AS feature, {_sql_round(f'w{i}')} AS coefficient, "
        f"{_sql_round(f'abs(w{i})')} AS abs_coefficient FROM {name}_s{_STEPS}"
        for i, f in enumerate(features, 1)
    ]
    return " UNION ALL ".join(rows)


@query("logit_experiment", _LOGIT_SQL + " UNION ALL ".join(_predicted_sql(n, f) for n, f in _LOGIT_SETS.items()))
def logit_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out predictions of two feature sets on the document labels."""
    return reduce(
        DataFrame.unionByName,
        [
            e.predictions.select(F.lit(e.name).alias("experiment"), "*").withColumn(
                "predicted_proba", half_even(F.col("predicted_proba"), 4)
            )
            for e in _document_experiment(spark, sf_dir)
        ],
    )


@query("logit_importance", _LOGIT_SQL + " UNION ALL ".join(_importance_sql(n, f) for n, f in _LOGIT_SETS.items()))
def logit_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            e.importance.select(
                F.lit(e.name).alias("experiment"), "feature",
                *[half_even(F.col(c), 4).alias(c) for c in ("coefficient", "abs_coefficient")],
            )
            for e in _document_experiment(spark, sf_dir)
        ],
    )


_SCORES = ("accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1", "tp", "tn", "fp", "fn")


def _scores_sql() -> str:
    """CTE ``scores``: all metrics of the baseline and of both fits on the held-out documents."""
    rows = [f"SELECT experiment, 'model' AS scored, quality, predicted_class AS p FROM ({_predicted_sql(n, f)})" for n, f in _LOGIT_SETS.items()]
    common = "(SELECT CAST(round_even(avg(quality), 0) AS INTEGER) FROM train)"
    rows += [f"SELECT '{n}', 'baseline', quality, {common} FROM scaled WHERE part = 'test'" for n in _LOGIT_SETS]
    metrics = _METRIC_SQL.replace("lang", "experiment").replace("shares AS", "all_shares AS").replace("FROM shares", "FROM all_shares")
    return f"scored_rows AS ({' UNION ALL '.join(rows)}), scores AS (WITH {metrics.strip()})"


def _flat_sql(prefix: str, scored: str) -> list[str]:
    return [f"max(CASE WHEN scored = '{scored}' THEN {m} END) AS {prefix}_{m}" for m in _SCORES]


@query(
    "document_metrics",
    _LOGIT_SQL + f""", {_scores_sql()}
    SELECT experiment, {", ".join(_flat_sql("baseline", "baseline") + _flat_sql("model", "model"))},
           (SELECT count(*) FROM labels) AS dataset_rows,
           CAST(CASE experiment WHEN 'size_only' THEN 1 ELSE 2 END AS INTEGER) AS features_count
    FROM scores GROUP BY experiment
    """,
)
def document_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics document of each fit on the document labels, flattened."""
    rows = reduce(DataFrame.unionByName, map(metrics_document, _document_experiment(spark, sf_dir)))
    flat = [F.col(f"{k}_metrics.{m}").alias(f"{k}_{m}") for k in ("baseline", "model") for m in _SCORES]
    return rows.select("experiment", *flat, "dataset_rows", "features_count")


@query(
    "document_comparison",
    _LOGIT_SQL + f""", {_scores_sql()}
    SELECT experiment, CAST(CASE experiment WHEN 'size_only' THEN 1 ELSE 2 END AS INTEGER) AS features_count,
           accuracy, balanced_accuracy, f1
    FROM scores WHERE scored = 'model'
    """,
)
def document_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison table of both fits."""
    return comparison(_document_experiment(spark, sf_dir))


@query(
    "comparison_payload",
    _LOGIT_SQL + f""", {_scores_sql()}
    SELECT experiment || '.' || scored AS entry, accuracy, f1, tp, tn, fp, fn FROM scores
    """,
)
def comparison_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison document as written to JSON and read back, a row per block of scores."""
    runs = _document_experiment(spark, sf_dir)
    path = scratch_path(spark, "comparison")
    export_json(comparison_document(runs), path)
    document = spark.read.json(path)
    blocks = [
        F.struct(F.lit(f"{e.name}.{k}").alias("entry"), *[F.col(f"{e.name}.{k}_metrics.{m}").alias(m) for m in ("accuracy", "f1", "tp", "tn", "fp", "fn")])
        for e in runs
        for k in ("baseline", "model")
    ]
    return document.select(F.inline(F.array(*blocks)))


@query(
    "vector_predictions",
    _LOGIT_SQL + " UNION ALL ".join(_predicted_sql(n, f) for n, f in _LOGIT_SETS.items()),
)
def vector_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document experiments again, from long rows and sparse vectors: equal predictions."""
    wide = _document_features(spark, sf_dir)
    cells = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in _LOGIT_SETS["size_and_language"]]))
    rows = wide.select("doc_id", cells).where("value IS NOT NULL")
    sets = {n: F.col("feature").isin(f) for n, f in _LOGIT_SETS.items()}
    return reduce(
        DataFrame.unionByName,
        [
            e.predictions.select(F.lit(e.name).alias("experiment"), "*").withColumn("predicted_proba", half_even(F.col("predicted_proba"), 4))
            for e in vector_ablation(wide, rows, sets, "quality", "doc_id")
        ],
    )
