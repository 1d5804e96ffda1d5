"""Answer scoring over conversation turns and labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.operators import qa_eval as E
from lexiloom.plans.bindings import NA_SQL, QA_SQL, na_scores, qa_pairs
from lexiloom.plans.registry import query, text_table
from lexiloom.plans.sqltext import normalized, normalized_tokens
from lexiloom.session import cut_lineage

# Per (question, answer): exact match and the token counts of the F1.
PAIRS = f"""
    q AS MATERIALIZED ({QA_SQL}),
    a0 AS (SELECT qid, has_answer, pred, unnest(answers) AS gold, generate_subscripts(answers, 1) AS ai FROM q),
    v1g AS (SELECT qid, ai, gold FROM a0),
    v2k AS (SELECT qid, ai, gold FROM a0 WHERE {normalized('gold')} <> ''),
    v2g AS (SELECT * FROM v2k UNION ALL SELECT qid, 1, '' FROM q WHERE qid NOT IN (SELECT qid FROM v2k))
"""


def scores_sql(source: str, empty_agrees: bool) -> str:
    both_empty = "WHEN np = 0 AND ng = 0 THEN 1.0" if empty_agrees else ""
    return f"""
      SELECT qid, max(em) AS exact, max(f1) AS f1 FROM (
        SELECT s.qid, s.ai, em, CASE {both_empty} WHEN coalesce(ov, 0) = 0 THEN 0.0
               ELSE 2.0::DOUBLE * ov / (np + ng) END AS f1
        FROM (SELECT g.qid, ai, CASE WHEN {normalized('pred')} = {normalized('gold')} THEN 1.0 ELSE 0.0 END AS em,
                len({normalized_tokens('pred')}) AS np, len({normalized_tokens('gold')}) AS ng
              FROM {source} g JOIN q ON g.qid = q.qid WHERE pred IS NOT NULL) s
        LEFT JOIN (
          SELECT x.qid, x.ai, sum(least(x.c, y.c)) AS ov FROM
            (SELECT qid, ai, t, count(*) AS c FROM (SELECT qid, ai, unnest({normalized_tokens('gold')}) AS t
              FROM {source}) GROUP BY ALL) x
            JOIN (SELECT qid, t, count(*) AS c FROM (SELECT qid, unnest({normalized_tokens('pred')}) AS t
              FROM q WHERE pred IS NOT NULL) GROUP BY ALL) y ON x.qid = y.qid AND x.t = y.t GROUP BY 1, 2
        ) o ON s.qid = o.qid AND s.ai = o.ai) GROUP BY qid
    """


def sides(spark, sf):
    j = qa_pairs(spark, sf)
    preds = j.where(F.col("pred").isNotNull()).select("qid", F.col("pred").alias("text"))
    return j.select("qid", "answers"), preds, j.select("qid", "na_prob")


def rounded(df, *cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else c for c in df.columns])


@query(
    "exact_match",
    f"WITH {PAIRS} SELECT q.qid, CASE WHEN {normalized('pred')} = {normalized('gold')} THEN 1.0::DOUBLE ELSE 0.0 END"
    " AS exact FROM q JOIN v1g ON q.qid = v1g.qid WHERE ai = 1 AND pred IS NOT NULL",
)
def _em(spark, sf):
    j = qa_pairs(spark, sf).where(F.col("pred").isNotNull() & (F.size("answers") > 0))
    return j.select("qid", E.exact_match(F.col("pred"), F.get("answers", 0)).alias("exact"))


@query(
    "token_f1",
    f"""
    WITH {PAIRS}, f AS (SELECT qid, ai, gold FROM v1g WHERE ai = 1)
    SELECT qid, round(f1, 6) AS f1 FROM ({scores_sql('f', False)})
    """,
)
def _f1(spark, sf):
    j = qa_pairs(spark, sf).where(F.col("pred").isNotNull() & (F.size("answers") > 0))
    return j.select("qid", F.round(E.token_f1(F.col("pred"), F.get("answers", 0)), 6).alias("f1"))


@query(
    "evaluate_v1",
    f"""
    WITH {PAIRS}, s AS ({scores_sql('v1g', False)})
    SELECT round(100.0 * avg(coalesce(exact, 0)), 6) AS exact_match, round(100.0 * avg(coalesce(f1, 0)), 6) AS f1,
           CAST(count(*) AS BIGINT) AS total, CAST(count(CASE WHEN pred IS NULL THEN 1 END) AS BIGINT) AS unanswered
    FROM q LEFT JOIN s ON q.qid = s.qid
    """,
)
def _v1(spark, sf):
    questions, preds, _ = sides(spark, sf)
    return rounded(E.evaluate_v1(questions, preds), "exact_match", "f1")


V2 = f"""
    {PAIRS}, s AS ({scores_sql('v2g', True)}),
    t AS (SELECT q.qid, has_answer, pred, na_prob, exact, f1,
            CASE WHEN na_prob > 0.5 THEN CASE WHEN has_answer THEN 0.0 ELSE 1.0 END ELSE exact END AS te,
            CASE WHEN na_prob > 0.5 THEN CASE WHEN has_answer THEN 0.0 ELSE 1.0 END ELSE f1 END AS tf
          FROM q LEFT JOIN s ON q.qid = s.qid)
"""


def _block(prefix: str, condition: str) -> str:
    return f"""
      round(100.0 * avg(CASE WHEN {condition} THEN te END), 6) AS "{prefix}exact",
      round(100.0 * avg(CASE WHEN {condition} THEN tf END), 6) AS "{prefix}f1",
      CAST(count(CASE WHEN {condition} THEN 1 END) AS BIGINT) AS "{prefix}total"
    """


@query(
    "evaluate_v2",
    f"""
    WITH {V2} SELECT {_block('', 'pred IS NOT NULL')}, {_block('HasAns_', 'pred IS NOT NULL AND has_answer')},
      {_block('NoAns_', 'pred IS NOT NULL AND NOT has_answer')},
      CAST(count(CASE WHEN pred IS NULL THEN 1 END) AS BIGINT) AS missing FROM t
    """,
)
def _v2(spark, sf):
    out = E.evaluate_v2(*sides(spark, sf), threshold=0.5)
    return rounded(out, *[c for c in out.columns if c.endswith(("exact", "f1"))])


@query(
    "apply_no_answer_threshold",
    f"""
    WITH n AS ({NA_SQL})
    SELECT qid, CASE WHEN na_prob > 0.6 THEN CASE WHEN has_answer THEN 0.0::DOUBLE ELSE 1.0 END ELSE score END AS score
    FROM n
    """,
)
def _threshold(spark, sf):
    n = na_scores(spark, sf)
    cut = E.apply_no_answer_threshold(F.col("score"), F.col("na_prob"), F.col("has_answer"), 0.6)
    return n.select("qid", cut.alias("score"))


def best_sql(source: str, score: str) -> str:
    return f"""
      SELECT round(100.0 * greatest(coalesce(max(run), -1), any_value(start)) / any_value(n), 6) AS best,
             CASE WHEN max(run) > any_value(start) THEN coalesce(arg_max(na_prob, (run, -na_prob)), 0) ELSE 0.0 END
               AS threshold,
             round(any_value(hm), 6) AS has_answer_mean
      FROM (SELECT count(CASE WHEN NOT has_answer THEN 1 END) AS start, count({score}) AS n,
              sum(CASE WHEN has_answer THEN coalesce({score}, 0) END) / count(CASE WHEN has_answer THEN 1 END) AS hm
            FROM {source}) z,
           (SELECT na_prob, round((SELECT count(CASE WHEN NOT has_answer THEN 1 END) FROM {source}) +
              sum(CASE WHEN has_answer THEN {score} WHEN answered THEN -1 ELSE 0 END)
              OVER (ORDER BY na_prob, qid ROWS UNBOUNDED PRECEDING), 9) AS run
            FROM {source} WHERE {score} IS NOT NULL) w
    """


@query("best_threshold", f"WITH n AS ({NA_SQL}) SELECT best, threshold FROM ({best_sql('n', 'score')})")
def _best(spark, sf):
    return rounded(E.best_threshold(na_scores(spark, sf)).select("best", "threshold"), "best")


@query(
    "best_threshold_v2",
    f"""
    WITH {V2}, u AS (SELECT *, pred <> '' AS answered FROM t)
    SELECT 'exact' AS metric, * FROM ({best_sql('u', 'exact')})
    UNION ALL SELECT 'f1' AS metric, * FROM ({best_sql('u', 'f1')})
    """,
)
def _best_v2(spark, sf):
    scored = cut_lineage(E.question_table(*sides(spark, sf)))
    return rounded(E.best_threshold(scored, "exact", "f1"), "best", "has_answer_mean")


def ap_sql(source: str, score: str) -> str:
    return f"""
      SELECT round(100.0 * sum(ctp / cn * tp) / (SELECT count(CASE WHEN has_answer THEN 1 END) FROM {source}), 6) AS ap
      FROM (SELECT na_prob, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn FROM (
        SELECT na_prob, CAST(count(*) AS DOUBLE) AS n,
               sum(CASE WHEN has_answer THEN coalesce(CAST({score} AS DOUBLE), 0) ELSE 0 END) AS tp
        FROM {source} GROUP BY na_prob) WINDOW w AS (ORDER BY na_prob ROWS UNBOUNDED PRECEDING))
    """


@query(
    "average_precision",
    f"""
    WITH {V2}, u AS (SELECT *, CASE WHEN has_answer THEN 1.0 ELSE 0.0 END AS oracle FROM t)
    SELECT 'exact' AS metric, ap FROM ({ap_sql('u', 'exact')})
    UNION ALL SELECT 'f1' AS metric, ap FROM ({ap_sql('u', 'f1')})
    UNION ALL SELECT 'oracle' AS metric, ap FROM ({ap_sql('u', 'oracle')})
    """,
)
def _ap(spark, sf):
    scored = cut_lineage(E.question_table(*sides(spark, sf))).withColumn("oracle", F.col("has_answer").cast("double"))
    return rounded(E.average_precision(scored, "exact", "f1", "oracle"), "ap")


def curve_sql(source: str, score: str) -> str:
    return f"""
      SELECT '{score}' AS metric, na_prob, round(ctp / cn, 6) AS precision,
             round(ctp / (SELECT count(CASE WHEN has_answer THEN 1 END) FROM {source}), 6) AS recall
      FROM (SELECT na_prob, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn FROM (
        SELECT na_prob, CAST(count(*) AS DOUBLE) AS n,
               sum(CASE WHEN has_answer THEN coalesce(CAST({score} AS DOUBLE), 0) ELSE 0 END) AS tp
        FROM {source} WHERE na_prob IS NOT NULL GROUP BY na_prob) WINDOW w AS (ORDER BY na_prob ROWS UNBOUNDED PRECEDING))
    """


@query(
    "precision_recall_curve",
    f"WITH {V2}, u AS (SELECT * FROM t) {curve_sql('u', 'exact')} UNION ALL {curve_sql('u', 'f1')}",
)
def _curve(spark, sf):
    scored = cut_lineage(E.question_table(*sides(spark, sf)))
    return rounded(E.precision_recall_curve(scored, "exact", "f1"), "precision", "recall")


@query(
    "na_prob_histogram",
    f"""
    WITH n AS ({NA_SQL}), b AS (SELECT has_answer, na_prob AS p, floor(na_prob * 20) AS g FROM n),
    c AS (SELECT has_answer, least(CASE WHEN p < g * 0.05::DOUBLE THEN g - 1
            WHEN p >= (g + 1) * 0.05::DOUBLE THEN g + 1 ELSE g END, 19) AS bin FROM b)
    SELECT has_answer, CAST(bin AS BIGINT) AS bin,
           round(count(*) / sum(CAST(count(*) AS DOUBLE)) OVER (PARTITION BY has_answer), 6) AS share
    FROM c GROUP BY has_answer, bin
    """,
)
def _histogram(spark, sf):
    return rounded(E.na_prob_histogram(na_scores(spark, sf)), "share")


@query(
    "token_f1_documents",
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    j AS MATERIALIZED (SELECT a.doc_id, {normalized_tokens('a.text')} AS p, {normalized_tokens('b.text')} AS g
      FROM d a JOIN d b ON b.doc_id = a.doc_id + 1),
    x AS (SELECT doc_id, t, count(*) AS c FROM (SELECT doc_id, unnest(p) AS t FROM j) GROUP BY ALL),
    y AS (SELECT doc_id, t, count(*) AS c FROM (SELECT doc_id, unnest(g) AS t FROM j) GROUP BY ALL),
    o AS (SELECT x.doc_id, sum(least(x.c, y.c)) AS ov FROM x JOIN y ON x.doc_id = y.doc_id AND x.t = y.t GROUP BY 1)
    SELECT j.doc_id, round(CASE WHEN coalesce(ov, 0) = 0 THEN 0.0 ELSE 2.0::DOUBLE * ov / (len(p) + len(g)) END, 6) AS f1
    FROM j LEFT JOIN o ON o.doc_id = j.doc_id
    """,
)
def _token_f1_documents(spark, sf):
    """Overlap of each document with the next: whole texts of up to tens of thousands of words."""
    d = text_table(spark, sf, "documents", "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    following = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("gold"))
    pairs = d.withColumnRenamed("text", "pred").join(following, "doc_id")
    return rounded(E.token_f1_rows(pairs, ["doc_id"], long_tokens=4000), "f1")
