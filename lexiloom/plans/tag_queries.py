"""Chunk extraction and scoring over the event sequences of each user."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.operators import tags as C
from lexiloom.plans.bindings import EVENT_TAGS_SQL, tagged_events
from lexiloom.session import cut_lineage
from lexiloom.plans.registry import query, table


def boundary_sql(column: str, source: str = "ev") -> str:
    return f"""
      SELECT *, (px <> 'O' AND (pp = 'O' OR brk)) AS starts, (pp <> 'O' AND (px = 'O' OR brk)) AS ends FROM (
        SELECT *, (pt IS DISTINCT FROM ty OR px IN ('B', 'S') OR pp IN ('E', 'S')) AS brk FROM (
          SELECT *, coalesce(lag(px) OVER w, 'O') AS pp, lag(ty) OVER w AS pt FROM (
            SELECT seq, pos, split_part({column}, '-', 1) AS px,
                   CASE WHEN {column} = 'O' THEN NULL ELSE split_part({column}, '-', 2) END AS ty FROM {source})
          WINDOW w AS (PARTITION BY seq ORDER BY pos)))
    """


def span_sql(column: str, source: str = "ev") -> str:
    return f"""
      SELECT seq, min(pos) AS st, max(pos) AS en, max(ty) AS ty FROM (
        SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY seq ORDER BY pos
          ROWS UNBOUNDED PRECEDING) AS id FROM ({boundary_sql(column, source)})) WHERE px <> 'O' GROUP BY seq, id
    """


EV = f"ev AS MATERIALIZED ({EVENT_TAGS_SQL})"
BOTH = f"""
    {EV}, g AS ({span_sql('gold')}), p AS ({span_sql('pred')}),
    m AS (SELECT coalesce(g.ty, p.ty) AS type, CASE WHEN g.seq IS NULL THEN 0 ELSE 1 END AS g,
                 CASE WHEN p.seq IS NULL THEN 0 ELSE 1 END AS p
          FROM g FULL JOIN p ON g.seq = p.seq AND g.st = p.st AND g.en = p.en AND g.ty = p.ty)
"""
RATES = """
    round(CASE WHEN sum(p) > 0 THEN 100.0 * sum(g * p) / sum(p) ELSE 0 END, 6) AS precision,
    round(CASE WHEN sum(g) > 0 THEN 100.0 * sum(g * p) / sum(g) ELSE 0 END, 6) AS recall,
    round(CASE WHEN sum(g * p) > 0 THEN 200.0 * sum(g * p) / (sum(g) + sum(p)) ELSE 0 END, 6) AS f1
"""
COUNTS = "CAST(sum(g) AS BIGINT) AS gold, CAST(sum(p) AS BIGINT) AS predicted, CAST(sum(g * p) AS BIGINT) AS correct"


def rounded(df):
    return df.select(
        *[F.round(c, 6).alias(c) if c in ("precision", "recall", "f1") else c for c in df.columns]
    )


def gold_and_pred(spark, sf):
    ev = tagged_events(spark, sf)
    return C.chunk_spans(ev, "gold"), C.chunk_spans(ev, "pred")


@query(
    "chunk_boundaries",
    f"WITH {EV} SELECT seq, CAST(pos AS BIGINT) AS pos, starts, ends FROM ({boundary_sql('pred')})",
)
def _boundaries(spark, sf):
    return C.chunk_boundaries(tagged_events(spark, sf), "pred").select("seq", "pos", "starts", "ends")


@query(
    "chunk_spans",
    f"""
    WITH {EV} SELECT seq, CAST(st AS BIGINT) AS start, CAST(en AS BIGINT) AS "end", ty AS type
    FROM ({span_sql('pred')})
    """,
)
def _spans(spark, sf):
    return C.chunk_spans(tagged_events(spark, sf), "pred", slab=64)


@query("chunk_scores", f"WITH {BOTH} SELECT {COUNTS}, {RATES} FROM m")
def _scores(spark, sf):
    return rounded(C.chunk_scores(*gold_and_pred(spark, sf)))


@query("chunk_report", f"WITH {BOTH} SELECT type, {COUNTS}, {RATES} FROM m GROUP BY type")
def _report(spark, sf):
    return rounded(C.chunk_report(*gold_and_pred(spark, sf)))


@query(
    "chunk_scores_flat",
    f"""
    WITH e0 AS ({EVENT_TAGS_SQL}),
    ev AS MATERIALIZED (SELECT 0 AS seq, row_number() OVER (ORDER BY seq, pos) - 1 AS pos, gold, pred FROM e0),
    g AS ({span_sql('gold')}), p AS ({span_sql('pred')}),
    m AS (SELECT CASE WHEN g.seq IS NULL THEN 0 ELSE 1 END AS g, CASE WHEN p.seq IS NULL THEN 0 ELSE 1 END AS p
          FROM g FULL JOIN p ON g.st = p.st AND g.en = p.en AND g.ty = p.ty)
    SELECT {COUNTS}, {RATES} FROM m
    """,
)
def _scores_flat(spark, sf):
    ev = C.flatten_sequences(tagged_events(spark, sf))
    return rounded(C.chunk_scores(C.chunk_spans(ev, "gold"), C.chunk_spans(ev, "pred")))


@query(
    "tag_accuracy",
    f"""
    WITH {EV} SELECT CAST(count(*) AS BIGINT) AS n_tokens,
      round(avg(CASE WHEN gold = pred THEN 100.0::DOUBLE ELSE 0 END), 6) AS accuracy,
      round(avg(CASE WHEN gold = 'O' THEN NULL WHEN gold = pred THEN 100.0::DOUBLE ELSE 0 END), 6) AS accuracy_inside
    FROM ev
    """,
)
def _accuracy(spark, sf):
    out = C.tag_accuracy(tagged_events(spark, sf))
    return out.select("n_tokens", *[F.round(c, 6).alias(c) for c in ("accuracy", "accuracy_inside")])


@query(
    "argmax_label",
    """
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    m AS (SELECT vec_id, list_position(v, list_max(v)) - 1 AS ix FROM e)
    SELECT vec_id, CAST(ix AS BIGINT) AS ix, 'tag' || (ix % 7) AS label FROM m
    """,
)
def _argmax(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    widest = e.agg(F.max(F.size("embedding")).alias("n"))  # one row
    places = cut_lineage(widest.select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("ix")))
    named = places.select(
        F.col("ix").cast("bigint").alias("ix"), F.concat(F.lit("tag"), (F.col("ix") % 7).cast("string")).alias("label")
    )
    return C.argmax_label(e, named, "embedding", spread=["vec_id"]).drop("embedding")
