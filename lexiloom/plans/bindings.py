"""Inputs of the operators, derived from the provided tables by fixed rules.

Each rule is written once for Spark and once for SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.operators.ordered import positions
from lexiloom.plans.registry import table, text_table
from lexiloom.plans.sqltext import QA_WS, qa_tok

# Event type to gold tag.
TAG_OF = {"click": "B-C", "view": "I-C", "purchase": "B-P", "signup": "I-P", "error": "O"}

_TAG_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TAG_OF.items()) + " END"
EVENT_TAGS_SQL = f"""
    SELECT event_id, user_id AS seq,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
           {_TAG_CASE} AS gold,
           CASE WHEN event_id % 5 = 0 THEN 'O' WHEN event_id % 7 = 0 THEN 'E-C' ELSE {_TAG_CASE} END AS pred
    FROM events
"""


def gold_tag(event_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, tag in TAG_OF.items():
        out = F.when(event_type == name, tag).otherwise(out)
    return out


def tagged_events(spark, sf) -> DataFrame:
    """Events of a user in time order as one tag sequence: (seq, pos, gold, pred)."""
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("seq"), "ts", "event_id", gold_tag(F.col("event_type")).alias("gold")
    )
    pred = F.when(F.col("event_id") % 5 == 0, "O").when(F.col("event_id") % 7 == 0, "E-C").otherwise(F.col("gold"))
    return positions(e.withColumn("pred", pred), ["seq"], ["ts", "event_id"]).drop("ts")


def pieces(token: Column) -> Column:
    """A stand-in for a subword tokenizer: the first four characters and the rest."""
    return F.when(
        F.length(token) > 4,
        F.array(
            F.substring(token, F.lit(1), F.lit(4)),
            F.concat(F.lit("##"), F.substring(token, F.lit(5), F.length(token))),
        ),
    ).otherwise(F.array(token))


def document_tokens(spark, sf) -> DataFrame:
    """Token stream of the documents: (doc_id, pos, term)."""
    d = text_table(spark, sf, "documents", "doc_id")
    return d.select("doc_id", F.posexplode(T.tokens(F.col("text"))).alias("pos", "term"))


def part_names(spark, sf) -> DataFrame:
    """Distinct part names with and without spaces: (key, text, gold); the name is the key."""
    p = table(spark, sf, "part").select(F.col("p_name").alias("gold")).distinct()
    return p.select(F.col("gold").alias("key"), F.replace("gold", F.lit(" "), F.lit("")).alias("text"), "gold")


# The mean F1 of each model, used as its weight.
MODEL_WEIGHTS = {
    "bert": (88.26 + 88.26 + 88.08) / 3,
    "albert": (88.85 + 89.38 + 89.40) / 3,
    "distilbert": (85.03 + 85.50 + 85.21) / 3,
    "albertAug": 89.46,
    "albertGoogle": 89.46,
}
# Event type to model.
MODEL_OF = {
    "click": "bert",
    "view": "albert",
    "purchase": "distilbert",
    "signup": "albertAug",
    "error": "albertGoogle",
}
_MODEL_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MODEL_OF.items()) + " END"
WEIGHTS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{m}', CAST({w!r} AS DOUBLE))" for m, w in MODEL_WEIGHTS.items()
) + ") AS t(model, weight)"
NBEST_SQL = f"""
    SELECT user_id AS qid, event_id, {_MODEL_CASE} AS model,
           't' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 7) AS text, value / 100 AS probability
    FROM events
"""


def model_weights(spark) -> DataFrame:
    return spark.createDataFrame(list(MODEL_WEIGHTS.items()), "model string, weight double")


def _model(event_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, model in MODEL_OF.items():
        out = F.when(event_type == name, model).otherwise(out)
    return out


def nbest_events(spark, sf) -> DataFrame:
    """Events as n-best rows: (qid, event_id, model, text, probability)."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("user_id").alias("qid"),
        "event_id",
        _model(F.col("event_type")).alias("model"),
        F.concat(F.lit("t"), (k % 7).cast("string")).alias("text"),
        (F.col("value") / 100).alias("probability"),
    )


# A question is a turn; its answers are the next two turns. One turn in three is
# predicted as the next turn, one in four as empty, some not at all.
QA_SQL = """
    SELECT c.conv_id * 100 + c.turn AS qid, (c.conv_id % 6 <> 0) AS has_answer,
           CASE WHEN c.conv_id % 6 = 0 THEN [] WHEN c2.text IS NULL THEN [c1.text] ELSE [c1.text, c2.text] END
             AS answers,
           CASE WHEN (c.conv_id + c.turn) % 9 = 0 THEN NULL WHEN c.turn % 4 = 3 THEN ''
                WHEN c.turn % 3 = 0 THEN c1.text ELSE c.text END AS pred,
           round(length(c.text) / (length(c.text) + 500.0::DOUBLE), 2) AS na_prob
    FROM conversations c
    JOIN conversations c1 ON c1.conv_id = c.conv_id AND c1.turn = c.turn + 1
    LEFT JOIN conversations c2 ON c2.conv_id = c.conv_id AND c2.turn = c.turn + 2
"""


def qa_pairs(spark, sf) -> DataFrame:
    """(qid, answers, pred, na_prob) of the conversations; the joins are on the
    whole (conversation, turn) key, so no conversation is paired with itself."""
    c = text_table(spark, sf, "conversations", "conv_id", "turn").select("conv_id", "turn", "text")

    def later(n: int) -> DataFrame:
        return c.select("conv_id", (F.col("turn") - n).alias("turn"), F.col("text").alias(f"t{n}"))

    j = c.join(later(1), ["conv_id", "turn"]).join(later(2), ["conv_id", "turn"], "left")
    conv, turn, n = F.col("conv_id"), F.col("turn"), F.length("text")
    return j.select(
        (conv * 100 + turn).alias("qid"),
        F.when(conv % 6 == 0, F.array().cast("array<string>"))
        .otherwise(F.filter(F.array("t1", "t2"), lambda t: t.isNotNull()))
        .alias("answers"),
        F.when((conv + turn) % 9 == 0, None)
        .when(turn % 4 == 3, "")
        .when(turn % 3 == 0, F.col("t1"))
        .otherwise(F.col("text"))
        .alias("pred"),
        F.round(n / (n + 500.0), 2).alias("na_prob"),
    )


# has-answer, score and no-answer probability of the labelled documents.
NA_SQL = """
    SELECT doc_id AS qid, quality = 1 AS has_answer, doc_id % 3 <> 0 AS answered,
           round(n_chars / (n_chars + 500.0::DOUBLE), 2) AS na_prob, CAST(1 - toxic AS DOUBLE) AS score
    FROM labels JOIN documents USING (doc_id)
"""


def na_scores(spark, sf) -> DataFrame:
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return j.select(
        F.col("doc_id").alias("qid"),
        (F.col("quality") == 1).alias("has_answer"),
        (F.col("doc_id") % 3 != 0).alias("answered"),
        F.round(F.col("n_chars") / (F.col("n_chars") + 500.0), 2).alias("na_prob"),
        (1 - F.col("toxic")).cast("double").alias("score"),
    )


# Documents as question rows: the question is the first ten tokens, the answer
# tokens 3 to 6. One answer in eleven cannot be found again; texts of fewer than
# seven tokens have no answer.
SQUAD_SQL = r"""
    SELECT doc_id AS qid, text AS context, toks, array_to_string(toks[1:10], ' ') AS question,
           len(toks) < 7 AS is_impossible,
           CASE WHEN len(toks) < 7 THEN NULL WHEN doc_id % 11 = 0 THEN 'zz' || array_to_string(toks[4:7], ' ')
                ELSE array_to_string(toks[4:7], ' ') END AS answer,
           length(regexp_extract(text, '^WS*([^WT]+WS+){3}')) AS answer_start
    FROM (SELECT doc_id, text, QATOK AS toks FROM documents)
""".replace("QATOK", qa_tok("text")).replace("WS", QA_WS).replace("[^WT]", "[^" + QA_WS[1:-1] + "]")


def squad_rows(spark, sf) -> DataFrame:
    """(qid, question, context, answers, is_impossible)."""
    d = text_table(spark, sf, "documents", "doc_id")
    toks = T.qa_tokens(F.col("text"))
    few = F.size("toks") < 7
    answer = F.array_join(F.slice("toks", 4, 4), " ")
    return d.select("doc_id", "text", toks.alias("toks")).select(
        F.col("doc_id").alias("qid"),
        F.array_join(F.slice("toks", 1, 10), " ").alias("question"),
        F.col("text").alias("context"),
        F.when(few, F.array().cast("array<struct<text:string,answer_start:int>>"))
        .otherwise(
            F.array(
                F.struct(
                    F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("zz"), answer)).otherwise(answer).alias("text"),
                    F.length(
                        F.regexp_extract("text", f"^{T.QA_SPACE}*([^{T.QA_SPACE[1:-1]}]+{T.QA_SPACE}+){{3}}", 0)
                    ).alias("answer_start"),
                )
            )
        )
        .alias("answers"),
        few.alias("is_impossible"),
    )


# Synonyms of a word: itself first; longer words have a second, their reverse.
SYNONYM_SQL = """
    SELECT DISTINCT w AS word, reverse(w) AS synonym FROM (SELECT unnest(toks) AS w FROM q) WHERE length(w) > 4
"""


def synonyms(spark, sf) -> DataFrame:
    """(word, rank, synonym) of all document tokens."""
    d = text_table(spark, sf, "documents", "doc_id")
    words = d.select(F.explode(T.qa_tokens(F.col("text"))).alias("word")).distinct()
    ranks = F.when(F.length("word") > 4, F.array("word", F.reverse("word"))).otherwise(F.array("word"))
    return words.select("word", F.posexplode(ranks).alias("rank", "synonym")).withColumn("rank", F.col("rank") + 1)


# Pages as long/short answer rows: everything from the third token on is the long
# answer, four tokens at a place that depends on the page the short one; a page in
# four has none.
NQ_SQL = f"""
    SELECT page_id AS qid, toks, 2 AS ls, len(toks) AS le,
           10 + page_id * 37 % greatest(len(toks) - 14, 1) AS ss, 14 + page_id * 37 % greatest(len(toks) - 14, 1) AS se,
           (page_id % 4 <> 0 AND len(toks) >= 20) AS has_short
    FROM (SELECT page_id, {qa_tok('html')} AS toks FROM pages)
"""


def nq_rows(spark, sf) -> DataFrame:
    """(example_id, question_text, document_text, annotations)."""
    p = text_table(spark, sf, "pages", "page_id").withColumn("n", F.size(T.qa_tokens(F.col("html"))))
    at = (F.col("page_id") * 37 % F.greatest(F.col("n") - 14, F.lit(1))).cast("int")
    short = F.struct((at + 10).alias("start_token"), (at + 14).alias("end_token"))
    has = (F.col("page_id") % 4 != 0) & (F.col("n") >= 20)
    return p.select(
        F.col("page_id").alias("example_id"),
        F.col("url").alias("question_text"),
        F.col("html").alias("document_text"),
        F.array(
            F.struct(
                F.struct(F.lit(2).alias("start_token"), F.col("n").alias("end_token")).alias(
                    "long_answer"
                ),
                F.when(has, F.array(short))
                .otherwise(F.array().cast("array<struct<start_token:int,end_token:int>>"))
                .alias("short_answers"),
            )
        ).alias("annotations"),
    )
