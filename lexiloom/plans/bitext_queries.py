"""Translation data and run scores over conversation turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.operators import bitext as B
from lexiloom.operators import score as H
from lexiloom.operators.ordered import positions
from lexiloom.plans.bindings import EVENT_TAGS_SQL, gold_tag
from lexiloom.plans.registry import query, table, text_table
from lexiloom.plans.sqltext import tok
from lexiloom.plans.tag_queries import span_sql

# A user turn and the assistant turn after it.
PAIRS = f"""
    bt AS (SELECT row_number() OVER (ORDER BY u.conv_id, u.turn) - 1 AS pair_id, u.conv_id, u.turn,
             {tok('lower(u.text)')} AS src, {tok('lower(a.text)')} AS tgt
           FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
           WHERE u.role = 'user' AND a.role = 'assistant')
"""


def pairs(spark, sf):
    c = text_table(spark, sf, "conversations", "conv_id", "turn")
    words = T.tokens(F.lower("text"))
    u = c.where(F.col("role") == "user").select("conv_id", "turn", words.alias("src"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), words.alias("tgt"))
    return positions(u.join(a, ["conv_id", "turn"]), [], ["conv_id", "turn"], "pair_id")


@query(
    "filter_bitext",
    f"""
    WITH {PAIRS} SELECT pair_id, CAST(len(src) AS BIGINT) AS src_len, CAST(len(tgt) AS BIGINT) AS tgt_len FROM bt
    WHERE len(src) <= 50 AND len(tgt) <= 50 AND len(src) > 2
    """,
)
def _filter(spark, sf):
    out = B.filter_bitext(pairs(spark, sf), 50, predicate=lambda d: F.size(d["src"]) > 2)
    return out.select(
        "pair_id", F.size("src").cast("bigint").alias("src_len"), F.size("tgt").cast("bigint").alias("tgt_len")
    )


@query(
    "length_buckets",
    f"""
    WITH {PAIRS} SELECT pair_id, CAST((row_number() OVER (ORDER BY len(src), pair_id) - 1) // 16 AS BIGINT) AS bucket
    FROM bt
    """,
)
def _buckets(spark, sf):
    return B.length_buckets(pairs(spark, sf), 16).select("pair_id", "bucket")


GRAMS = f"""
    ln AS (SELECT {{by}} AS by_key, conv_id, turn, {tok('lower(text)')} AS r,
             {tok("lower(replace(replace(text, ' the ', ' a '), ' la ', ' '))")} AS h FROM conversations),
    tk AS (SELECT by_key, conv_id, turn, 1 AS side, unnest(r) AS w, generate_subscripts(r, 1) AS p FROM ln
           UNION ALL SELECT by_key, conv_id, turn, 2 AS side, unnest(h), generate_subscripts(h, 1) FROM ln),
    nx AS (SELECT *, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM tk
           WINDOW o AS (PARTITION BY conv_id, turn, side ORDER BY p)),
    gr AS (SELECT by_key, conv_id, turn, side, 1 AS n, w AS g FROM nx
           UNION ALL SELECT by_key, conv_id, turn, side, 2, w || ' ' || w2 FROM nx WHERE w2 IS NOT NULL
           UNION ALL SELECT by_key, conv_id, turn, side, 3, w || ' ' || w2 || ' ' || w3 FROM nx WHERE w3 IS NOT NULL
           UNION ALL SELECT by_key, conv_id, turn, side, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM nx
             WHERE w4 IS NOT NULL),
    ct AS (SELECT by_key, conv_id, turn, n, g, count(CASE WHEN side = 1 THEN 1 END) AS r,
             count(CASE WHEN side = 2 THEN 1 END) AS h FROM gr GROUP BY ALL),
    sm AS (SELECT by_key, n, CAST(sum(least(r, h)) AS DOUBLE) AS c, CAST(sum(h) AS DOUBLE) AS t,
             CAST(sum(r) AS DOUBLE) AS rt FROM ct GROUP BY by_key, n),
    bl AS (SELECT by_key, max(CASE WHEN n = 1 THEN rt END) AS rl, max(CASE WHEN n = 1 THEN t END) AS hl,
             100.0 * max(CASE WHEN n = 1 THEN c / t END) AS p1, 100.0 * max(CASE WHEN n = 2 THEN c / t END) AS p2,
             100.0 * max(CASE WHEN n = 3 THEN c / t END) AS p3, 100.0 * max(CASE WHEN n = 4 THEN c / t END) AS p4
           FROM sm GROUP BY by_key),
    sb AS (SELECT *, CASE WHEN hl >= rl THEN 1.0 ELSE exp(1 - rl / hl) END
             * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) AS bleu FROM bl)
"""


def lines(spark, sf, *extra):
    """Reference lines and the same lines with some words changed or lost."""
    c = text_table(spark, sf, "conversations", "conv_id", "turn")
    changed = F.replace(F.replace("text", F.lit(" the "), F.lit(" a ")), F.lit(" la "), F.lit(" "))
    return (
        c.select("conv_id", "turn", *extra, "text"),
        c.select("conv_id", "turn", *extra, changed.alias("text")),
    )


@query(
    "corpus_bleu",
    f"""
    WITH {GRAMS.replace('{by}', "'all'")}
    SELECT round(bleu, 6) AS bleu, CAST(rl AS BIGINT) AS ref_len, CAST(hl AS BIGINT) AS hyp_len, round(p1, 6) AS p1,
           round(p2, 6) AS p2, round(p3, 6) AS p3, round(p4, 6) AS p4 FROM sb
    """,
)
def _bleu(spark, sf):
    ref, hyp = lines(spark, sf)
    out = B.corpus_bleu(ref, hyp, ("conv_id", "turn"))
    return out.select(*[F.round(c, 6).alias(c) if c[0] in "bp" else c for c in out.columns])


@query(
    "score_runs",
    f"""
    WITH {GRAMS.replace('{by}', 'role')}
    SELECT 'good' AS run, by_key AS testset, round(bleu, 6) AS score FROM sb
    UNION ALL SELECT 'short', by_key, CASE WHEN EXISTS (SELECT 1 FROM conversations WHERE role = by_key
      AND (conv_id * 100 + turn) % 7 = 0) THEN 0.0::DOUBLE ELSE round(bleu, 6) END FROM sb
    UNION ALL SELECT DISTINCT 'absent', role, 0.0::DOUBLE FROM conversations
    """,
)
def _score(spark, sf):
    ref, hyp = lines(spark, sf, "role")
    line = (F.col("conv_id") * 100 + F.col("turn")).alias("line_no")
    gold = ref.select(F.col("role").alias("testset"), line, "text")
    good = hyp.select(F.lit("good").alias("run"), F.col("role").alias("testset"), line, "text")
    short = good.where(F.col("line_no") % 7 != 0).withColumn("run", F.lit("short"))
    names = spark.createDataFrame([("good",), ("short",), ("absent",)], "run string")
    return H.score_runs(gold, good.unionByName(short), names, "bleu").withColumn("score", F.round("score", 6))


# Every eleventh line of the gold is blank; there the run has a word of its own.
BLANK = "(conv_id * 100 + turn) % 11 = 0"
SHORT_OR_ABSENT = """
    UNION ALL SELECT 'short', testset, CASE WHEN EXISTS (SELECT 1 FROM conversations WHERE role = testset
      AND (conv_id * 100 + turn) % 7 = 0) THEN 0.0::DOUBLE ELSE score END FROM sc
    UNION ALL SELECT 'absent', testset, 0.0::DOUBLE FROM sc
"""


def scored_lines(spark, sf, gold_text, run_text, metric):
    """Scores of three runs over lines with blanks: all of it, a shorter one, none."""
    line = F.col("conv_id") * 100 + F.col("turn")
    blank = line % 11 == 0
    c = text_table(spark, sf, "conversations", "conv_id", "turn").select(
        F.col("role").alias("testset"), line.alias("line_no"),
        F.when(blank, F.lit(" ")).otherwise(gold_text).alias("g"), F.when(blank, F.lit("x")).otherwise(run_text).alias("p"),
    )
    gold = c.select("testset", "line_no", F.col("g").alias("text"))
    good = c.select(F.lit("good").alias("run"), "testset", "line_no", F.col("p").alias("text"))
    short = good.where(F.col("line_no") % 7 != 0).withColumn("run", F.lit("short"))
    names = spark.createDataFrame([("good",), ("short",), ("absent",)], "run string")
    return H.score_runs(gold, good.unionByName(short), names, metric).withColumn("score", F.round("score", 6))


@query(
    "score_runs_segmentation",
    f"""
    WITH ln AS (SELECT role AS testset, conv_id, turn, CASE WHEN {BLANK} THEN '' ELSE text END AS g,
             CASE WHEN {BLANK} THEN 'x' ELSE replace(replace(text, ' the ', ' a '), ' la ', ' ') END AS p
           FROM conversations),
    tk AS (SELECT testset, conv_id, turn, unnest({tok('g')}) AS w, -1 AS d FROM ln
           UNION ALL SELECT testset, conv_id, turn, unnest({tok('p')}), 1 FROM ln),
    df AS (SELECT testset, conv_id, turn, w, sum(d) AS d FROM tk GROUP BY ALL),
    sc AS (SELECT testset, round(2.0 * count(*) FILTER (WHERE d = 0) / (count(*) + count(*) FILTER (WHERE d = 0)), 6)
             AS score FROM df GROUP BY testset)
    SELECT 'good' AS run, testset, score FROM sc {SHORT_OR_ABSENT}
    """,
)
def _score_segmentation(spark, sf):
    changed = F.replace(F.replace("text", F.lit(" the "), F.lit(" a ")), F.lit(" la "), F.lit(" "))
    return scored_lines(spark, sf, F.col("text"), changed, "segmentation")


@query(
    "score_runs_hits",
    f"""
    WITH ln AS (SELECT role AS testset, {tok('text')} AS w, {BLANK} AS blank FROM conversations),
    hit AS (SELECT testset, CASE WHEN blank THEN false ELSE list_has_any(w[3:12], w[1:2]) END AS hit FROM ln),
    sc AS (SELECT testset, round(100.0 * avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 6) AS score FROM hit GROUP BY testset)
    SELECT 'good' AS run, testset, score FROM sc {SHORT_OR_ABSENT}
    """,
)
def _score_hits(spark, sf):
    words = T.tokens(F.col("text"))
    known = F.concat(F.lit("word.n\t"), F.array_join(F.slice(words, 1, 2), " "))
    guessed = F.array_join(F.slice(words, F.lit(3), F.size(words)), " ")
    return scored_lines(spark, sf, known, guessed, "hits")


@query(
    "score_runs_chunks",
    f"""
    WITH e0 AS ({EVENT_TAGS_SQL}),
    ev AS MATERIALIZED (SELECT 0 AS seq, row_number() OVER (ORDER BY event_id) - 1 AS pos, gold, pred FROM e0),
    g AS ({span_sql('gold')}), p AS ({span_sql('pred')}),
    m AS (SELECT CASE WHEN g.seq IS NULL THEN 0 ELSE 1 END AS g, CASE WHEN p.seq IS NULL THEN 0 ELSE 1 END AS p
          FROM g FULL JOIN p ON g.st = p.st AND g.en = p.en AND g.ty = p.ty)
    SELECT 'good' AS run, 'events' AS testset, round(200.0 * sum(g * p) / (sum(g) + sum(p)), 6) AS score FROM m
    UNION ALL SELECT 'absent', 'events', 0.0::DOUBLE
    """,
)
def _score_chunks(spark, sf):
    """One tag a line; a blank line after every thirteenth event ends a sequence and does not count."""
    e = table(spark, sf, "events").select("event_id", gold_tag(F.col("event_type")).alias("gold"))
    pred = F.when(F.col("event_id") % 5 == 0, "O").when(F.col("event_id") % 7 == 0, "E-C").otherwise(F.col("gold"))
    blank = F.when(F.col("event_id") % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    at = e.withColumn("pred", pred).withColumn("after", F.explode(blank))

    def lines_of(column):
        text = F.when(F.col("after") == 0, F.col(column)).otherwise(F.lit(""))
        return at.select(F.lit("events").alias("testset"), (2 * F.col("event_id") + F.col("after")).alias("line_no"), text.alias("text"))

    names = spark.createDataFrame([("good",), ("absent",)], "run string")
    runs = lines_of("pred").withColumn("run", F.lit("good"))
    return H.score_runs(lines_of("gold"), runs, names, "chunks").withColumn("score", F.round("score", 6))
