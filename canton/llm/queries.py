"""The registered queries of the corpus operators, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from canton.llm.covertree import near_vectors
from canton.llm.dialogs import damage, repair_conversations
from canton.llm.line_dedup import dedup_lines
from canton.llm.mixing import sample_mix
from canton.llm.mtree import exact_top_k
from canton.llm.negatives import hard_negatives, relabelled
from canton.llm.ngram_join import near_duplicates
from canton.llm.repeats import remove_repeats
from canton.llm.secrets import secret_scan
from canton.llm.sentencepieces import encode_documents
from canton.llm.spotsigs import edited_fingerprints
from canton.llm.token_counts import token_counts
from canton.llm.toxicity import fit, labelled_sample, score_toxicity

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit(*labelled_sample(docs, table(spark, sf_dir, "labels"))))


@query("op2_ngram_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_spot_signatures")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op4_line_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, counts=True)


@query("op5_source_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_mix(table(spark, sf_dir, "documents")).drop("mark")


@query(
    "op6_exact_top_k",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id
      WHERE q.vec_id % 100 = 0
    ), ranked AS (
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score
      FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


@query(
    "op11_cover_tree",
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), link AS (
      SELECT a.vec_id AS a, b.vec_id AS b
      FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.v, b.v) >= 0.98
    ), reach AS (
      SELECT a, b FROM link
      UNION
      SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
    ), least AS (
      SELECT a, min(b) AS b FROM reach GROUP BY a
    ), degree AS (
      SELECT a, count(*) AS n FROM link GROUP BY a
    )
    SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
           e.vec_id = least(e.vec_id, coalesce(l.b, e.vec_id)) AS kept
    FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.a LEFT JOIN least l ON e.vec_id = l.a
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query(
    "op12_hard_negatives",
    """
    WITH v AS (
      SELECT row_number() OVER () AS r, vec_id,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT a.r, a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.r <> c.r
      WHERE a.vec_id % 100 = 0
    ), positive AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, id) AS no FROM scored
        WHERE same AND id <> anchor_id
      ) WHERE no <= 5
    ), ranked AS (
      SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.r, p.no ORDER BY n.score DESC, n.id) AS INTEGER) AS rank
      FROM positive p JOIN scored n ON p.r = n.r AND NOT n.same
      WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(table(spark, sf_dir, "embeddings")))


def _least_edit(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edit(state: str, cost: str, letter: str, line: str | None = None, when: str = "NOT gone") -> str:
    """SQL of a state's (cost, audit, text) after an edit; NULL where it does not apply."""
    text = f"{state}.text" if line is None else f"coalesce({state}.text || chr(10), '') || {line}"
    value = f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'text': {text}}}"
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {value} END"


def _repaired(states: str, initial: str, name: str) -> list[str]:
    """SQL of all edits that make the next turn ``name`` after one of the states."""
    out = []
    for state in states.split():
        out.append(_edit(state, "late", "K", "role || ':' || words", f"NOT gone AND role[1] = '{initial}'"))
        if initial != "s":
            out.append(_edit(state, "late + 1", "R", f"'{name}:' || words"))
    return out


# States: nothing yet, a system turn, a user turn, an assistant turn. An inserted turn costs
# more than deleting it and its partner, or both turns of the pair, so it is never cheapest.
_DIALOG_SQL = f"""
    WITH RECURSIVE given AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
      FROM conversations
    ), marked AS (
      SELECT *, xor(list_reduce(
               list_prepend(4294967295, list_transform(range(length(key)), lambda i: CAST(ascii(key[i + 1]) AS BIGINT))),
               lambda c, b: list_reduce(
                 list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))
             ), 4294967295) % 20 AS fault
      FROM given
    ), hurt AS (
      SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
             CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS words
      FROM marked JOIN (SELECT unnest([0, 1]) AS copy) ON copy = 0 OR fault = 3
      WHERE fault <> 0
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, words) AS i FROM hurt
    ), judged AS (
      SELECT *, NOT regexp_matches(words, '[^\x20\x09-\x0D]') AS blank,
             row_number() OVER (PARTITION BY conv_id, role, words ORDER BY i) > 1 AS seen,
             NOT regexp_matches(words, '[.!?][\x20\x09-\x0D]*$') AS cut,
             lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS bad
      FROM placed
    ), row_of AS (
      SELECT conv_id, i, role, words, blank OR seen AS gone,
             CASE WHEN cut AND NOT blank AND NOT seen THEN 5 ELSE 0 END AS late
      FROM judged
    ), walk AS (
      SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i,
             {{'cost': CAST(0 AS BIGINT), 'audit': '', 'text': CAST(NULL AS VARCHAR)}} AS e,
             CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, text VARCHAR)) AS s,
             CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, text VARCHAR)) AS u,
             CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, text VARCHAR)) AS a
      FROM conversations
      UNION ALL
      SELECT w.conv_id, r.i,
             {_edit("e", "2", "D", when="true")} AS e,
             {_least_edit(_edit("s", "2", "D", when="true"), *_repaired("e", "s", "system"))} AS s,
             {_least_edit(_edit("u", "2", "D", when="true"), *_repaired("e s a", "u", "user"))} AS u,
             {_least_edit(_edit("a", "2", "D", when="true"), *_repaired("u", "a", "assistant"))} AS a
      FROM walk w JOIN row_of r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1
    ), best AS (
      SELECT conv_id, list_min([e, a]) AS b FROM walk
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
    ), counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
             count(*) FILTER (cut AND NOT blank AND NOT seen) AS truncated, count(*) FILTER (bad) AS illegal
      FROM judged GROUP BY conv_id
    )
    SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b.b.cost AS cost, b.b.audit AS audit,
           sha256(coalesce(b.b.text, '')) AS repaired_sha256
    FROM best b LEFT JOIN counted c ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op13_dialog_repair", _DIALOG_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(table(spark, sf_dir, "conversations")))
