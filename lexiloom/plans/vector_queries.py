"""Word vectors over the embeddings table; neighbours share a label."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.functions import vectors as FV
from lexiloom.operators import vectors as V
from lexiloom.operators.nearest import nearest_in_cells
from lexiloom.operators.ordered import positions
from lexiloom.operators.skew import spread_join
from lexiloom.plans.registry import query, table

VEC = "vec AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
EDGES = """
    ed AS (SELECT a.vec_id AS head, b.vec_id AS nb FROM
      (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) a JOIN
      (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) b
      ON a.label = b.label AND b.r BETWEEN a.r + 1 AND a.r + 3)
"""
# The word "w<id>"; a sentence is the five words from an id on, the target one of the first three.
WORDS = f"{VEC}, wv AS MATERIALIZED (SELECT 'w' || vec_id AS word, v FROM vec)"
SENTENCES = """
    se AS (SELECT vec_id AS qid, vec_id % 3 AS ti,
             list_transform(range(vec_id, vec_id + 5), lambda i: 'w' || i) AS toks FROM embeddings)
"""
NEAREST = """
    sm AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY word ORDER BY sim DESC, other) AS rank FROM (
      SELECT a.word, b.word AS other, round(list_cosine_similarity(a.v, b.v), 12) AS sim FROM wv a JOIN wv b
      ON a.word <> b.word))
"""


def word_vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select(F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), F.col("embedding").alias("vec"))


def id_vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("word"), F.col("embedding").alias("vec"))


def label_edges(spark, sf):
    """Each id with the next three of its label, by position, not by pairing a label with itself."""
    placed = positions(table(spark, sf, "embeddings").select("label", "vec_id"), ["label"], ["vec_id"])
    reach = placed.select(
        "label", F.col("vec_id").alias("head"), F.explode(F.sequence(F.col("pos") + 1, F.col("pos") + 3)).alias("pos")
    )
    return reach.join(placed, ["label", "pos"]).select("head", F.col("vec_id").alias("neighbour"))


def sentences(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id")
    ids = F.sequence(F.col("vec_id"), F.col("vec_id") + 4)
    return e.select(
        F.col("vec_id").alias("qid"),
        (F.col("vec_id") % 3).cast("int").alias("target_idx"),
        F.transform(ids, lambda i: F.concat(F.lit("w"), i.cast("string"))).alias("tokens"),
    )


@query(
    "l2_normalize",
    f"""
    WITH {VEC}, n AS (SELECT vec_id, v, sqrt(list_inner_product(v, v) + 1e-6) AS n FROM vec)
    SELECT vec_id, round(v[1] / n, 6) AS first, round(list_sum(v) / n, 6) AS total FROM n
    """,
)
def _normalize(spark, sf):
    n = id_vectors(spark, sf).select("word", FV.l2_normalize(F.col("vec")).alias("u"))
    return n.select(
        F.col("word").alias("vec_id"),
        F.round(F.get("u", 0), 6).alias("first"),
        F.round(F.aggregate("u", F.lit(0.0), lambda t, x: t + x), 6).alias("total"),
    )


@query(
    "cosine",
    f"""
    WITH {VEC} SELECT a.vec_id, round(list_cosine_similarity(a.v, b.v), 6) AS cos,
      round((list_cosine_similarity(a.v, b.v) + 1) / 2, 6) AS pcos
    FROM vec a JOIN vec b ON b.vec_id = a.vec_id + 1
    """,
)
def _cosine(spark, sf):
    v = id_vectors(spark, sf)
    following = v.select((F.col("word") - 1).alias("word"), F.col("vec").alias("b"))
    j = v.join(following, "word")
    return j.select(
        F.col("word").alias("vec_id"),
        F.round(FV.cosine(F.col("vec"), F.col("b")), 6).alias("cos"),
        F.round(FV.pcos(F.col("vec"), F.col("b")), 6).alias("pcos"),
    )


@query(
    "most_similar",
    f"""
    WITH {WORDS}, {NEAREST}
    SELECT word, CAST(rank AS BIGINT) AS rank, other, round(sim, 6) AS sim FROM sm WHERE rank <= 10
    """,
)
def _similar(spark, sf):
    w = word_vectors(spark, sf)
    return V.most_similar(w, w, 10).select(
        "word", F.col("rank").cast("bigint").alias("rank"), "other", F.round("sim", 6).alias("sim")
    )


@query("nearest_in_cells")
def _nearest_in_cells(spark, sf):
    """Every hundredth vector against all, through the inverted file: approximate, so without SQL."""
    table, words = id_vectors(spark, sf), F.col("word")
    found = nearest_in_cells(table.where(words % 100 == 0), table, 10)
    return found.select(words.alias("vec_id"), F.col("rank").cast("bigint").alias("rank"), F.col("other").alias("other_id"), F.round("sim", 6).alias("sim"))


def _round_sql(name: str, previous: str) -> str:
    """One smoothing round in long form (id, dimension, value)."""
    return f"""
      {name}s AS (SELECT head, d, sum(x) AS sx, count(*) AS n FROM ed JOIN {previous} ON nb = vec_id GROUP BY head, d),
      {name} AS MATERIALIZED (SELECT o.vec_id, o.d, CASE WHEN sx IS NULL THEN o.x
                ELSE (1.0 * o.x + 2.19 * sx) / (n * 3.19) END AS x
              FROM lo o LEFT JOIN {name}s s ON s.head = o.vec_id AND s.d = o.d)
    """


@query(
    "retrofit",
    f"""
    WITH {VEC}, {EDGES},
    lo AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM vec),
    {_round_sql('r1', 'lo')}, {_round_sql('r2', 'r1')}, {_round_sql('r3', 'r2')}, {_round_sql('r4', 'r3')}
    SELECT vec_id, CAST(d AS BIGINT) AS dim, round(x, 6) AS value FROM r4
    """,
)
def _retrofit(spark, sf):
    out = V.retrofit(id_vectors(spark, sf), label_edges(spark, sf), iters=4)
    return out.select(F.col("word").alias("vec_id"), F.posexplode("vec").alias("d", "x")).select(
        "vec_id", (F.col("d") + 1).cast("bigint").alias("dim"), F.round("x", 6).alias("value")
    )


CONTEXT = f"""
    cx AS (SELECT DISTINCT qid, w FROM (SELECT qid, ti, unnest(toks) AS w, generate_subscripts(toks, 1) - 1 AS p FROM se)
           WHERE p <> ti),
    cn AS (SELECT qid, w, v, count(*) OVER (PARTITION BY qid) AS n FROM cx JOIN wv ON wv.word = cx.w),
    ca AS (SELECT qid, toks[ti + 1] AS target, other FROM se JOIN sm ON sm.word = toks[ti + 1] WHERE rank <= 10),
    sc AS (SELECT ca.qid, ca.other, round((list_cosine_similarity(any_value(o.v), any_value(t.v)) * any_value(n)
             + sum(list_cosine_similarity(o.v, cn.v))) / (2 * any_value(n)), 12) AS score
           FROM ca JOIN wv o ON o.word = ca.other JOIN wv t ON t.word = ca.target JOIN cn ON cn.qid = ca.qid
           GROUP BY ca.qid, ca.other),
    rr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, other) AS r FROM sc)
"""


@query(
    "rerank_in_context",
    f"""
    WITH {WORDS}, {SENTENCES}, {NEAREST}, {CONTEXT}
    SELECT qid, CAST(r AS BIGINT) AS rank, other, round(score, 6) AS score FROM rr WHERE r <= 10
    """,
)
def _rerank(spark, sf):
    w, s = word_vectors(spark, sf), sentences(spark, sf)
    targets = s.select("qid", F.get("tokens", F.col("target_idx")).alias("word"))
    found = V.most_similar(w.join(targets.select("word").distinct(), "word", "left_semi"), w, 10)
    cands = spread_join(targets, found, ["word"], "inner", ["qid"]).select("qid", "other")
    return V.rerank_in_context(cands, s, w).select(
        "qid", F.col("rank").cast("bigint").alias("rank"), "other", F.round("score", 6).alias("score")
    )


@query(
    "substitutes",
    f"""
    WITH {WORDS}, {SENTENCES}, {NEAREST}
    SELECT qid, coalesce((SELECT string_agg(other, ' ' ORDER BY rank) FROM sm WHERE sm.word = toks[ti + 1]
      AND rank <= 5), '') AS guesses FROM se
    """,
)
def _substitutes(spark, sf):
    out = V.substitutes(sentences(spark, sf), word_vectors(spark, sf), 5)
    return out.select("qid", F.array_join("guesses", " ").alias("guesses"))


@query(
    "substitutes_in_context",
    f"""
    WITH {WORDS}, {SENTENCES}, {NEAREST}, {CONTEXT}
    SELECT se.qid, coalesce(string_agg(other, ' ' ORDER BY r), '') AS guesses
    FROM se LEFT JOIN (SELECT * FROM rr WHERE r <= 3) x ON x.qid = se.qid GROUP BY se.qid
    """,
)
def _substitutes_context(spark, sf):
    out = V.substitutes(sentences(spark, sf), word_vectors(spark, sf), 10, context=True, topn=3)
    return out.select("qid", F.array_join("guesses", " ").alias("guesses"))


@query(
    "hit_precision",
    f"""
    WITH {WORDS}, {SENTENCES}, {NEAREST}, {EDGES},
    g AS (SELECT DISTINCT se.qid FROM se JOIN sm ON sm.word = toks[ti + 1] AND rank <= 10
          JOIN ed ON 'w' || ed.head = toks[ti + 1] AND 'w' || ed.nb = sm.other),
    k AS (SELECT DISTINCT se.qid FROM se JOIN ed ON 'w' || ed.head = toks[ti + 1])
    SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN g.qid IS NULL THEN 0.0::DOUBLE ELSE 1.0 END), 6) AS precision
    FROM k LEFT JOIN g ON k.qid = g.qid
    """,
)
def _hits(spark, sf):
    s = sentences(spark, sf)
    name = lambda c: F.concat(F.lit("w"), F.col(c).cast("string"))
    gold_of = (
        label_edges(spark, sf)
        .groupBy("head")
        .agg(F.collect_set(name("neighbour")).alias("gold"))
        .select(name("head").alias("word"), "gold")
    )
    targets = s.select("qid", F.get("tokens", F.col("target_idx")).alias("word"))
    gold = spread_join(targets, gold_of, ["word"], "inner", ["qid"]).select("qid", "gold")
    out = V.hit_precision(gold, V.substitutes(s, word_vectors(spark, sf), 10))
    return out.withColumn("precision", F.round("precision", 6))
