"""Model ensembles over events read as n-best lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.operators import ensemble as N
from lexiloom.plans.bindings import NBEST_SQL, WEIGHTS_SQL, model_weights, nbest_events
from lexiloom.plans.registry import query


def best_sql(score: str) -> str:
    return f"""
      WITH n AS ({NBEST_SQL}), w AS ({WEIGHTS_SQL}),
      s AS (SELECT qid, text, round(sum({score}), 9) AS score FROM n JOIN w USING (model) GROUP BY 1, 2)
      SELECT qid, text, round(score, 6) AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, text) AS rn FROM s) WHERE rn = 1
    """


@query("ensemble_vote", best_sql("weight"))
def _vote(spark, sf):
    out = N.ensemble_vote(nbest_events(spark, sf), model_weights(spark))
    return out.withColumn("score", F.round("score", 6))


@query("ensemble_probability_sum", best_sql("probability * weight"))
def _sum(spark, sf):
    out = N.ensemble_probability_sum(nbest_events(spark, sf), model_weights(spark))
    return out.withColumn("score", F.round("score", 6))


@query(
    "ensemble_stochastic",
    f"""
    WITH RECURSIVE n AS ({NBEST_SQL}), w AS ({WEIGHTS_SQL}),
    l AS (SELECT qid, model, text, row_number() OVER (PARTITION BY qid, model ORDER BY event_id DESC) AS rn FROM n),
    o AS (SELECT qid, text, weight, row_number() OVER (PARTITION BY qid ORDER BY model) AS i
          FROM l JOIN w USING (model) WHERE rn = 1),
    f AS (
      SELECT qid, i, text, weight FROM o WHERE i = 1
      UNION ALL
      SELECT o.qid, o.i, CASE WHEN keep THEN ft ELSE o.text END, CASE WHEN keep THEN fw ELSE o.weight END FROM (
        SELECT o.*, f.text AS ft, f.weight AS fw,
               (f.weight > o.weight AND ((o.qid * 7 + (o.i - 1) * 13 + 5) % 100) / 100.0 < 0.85) AS keep
        FROM f JOIN o ON o.qid = f.qid AND o.i = f.i + 1) o
    )
    SELECT qid, text FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY i DESC) AS rn FROM f) WHERE rn = 1
    """,
)
def _stochastic(spark, sf):
    rows = nbest_events(spark, sf)
    last = (
        rows.groupBy("qid", "model")
        .agg(F.max_by("text", "event_id").alias("text"))
    )
    draw = lambda qid, step: ((qid * 7 + step * 13 + 5) % 100) / 100.0
    return N.ensemble_stochastic(last, model_weights(spark), 0.85, draw)
