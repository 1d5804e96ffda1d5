"""Sources and sinks: tables are written in each text format by Spark and read back.

The files go to a new folder under the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.functions.arrays import entries
from lexiloom.plans.bindings import EVENT_TAGS_SQL, NBEST_SQL, nbest_events, nq_rows, squad_rows, tagged_events
from lexiloom.plans.bitext_queries import PAIRS
from lexiloom.plans.ngram_queries import TURN_STREAM
from lexiloom.plans.registry import query, table, text_table
from lexiloom.plans.sqltext import qa_tok
from lexiloom.plans.vector_queries import EDGES, VEC, id_vectors, label_edges, sentences
from lexiloom.session import cut_lineage, shared_dir
from lexiloom.sources import conll, lines, qa_json, tables


def new_path(spark) -> str:
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"


@query(
    "read_counts",
    f"SELECT term AS gram, CAST(count(*) AS BIGINT) AS cnt FROM ({TURN_STREAM}) GROUP BY term",
)
def _counts(spark, sf):
    path = new_path(spark)
    c = text_table(spark, sf, "conversations", "conv_id", "turn").select("role", T.tokens(F.col("text")).alias("tokens"))
    # One count table per role: words of both roles are repeated keys in the file.
    per_role = c.select("role", F.explode(entries(F.col("tokens"))).alias("gram")).groupBy("role", "gram").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    tables.write_counts(per_role, path)
    return tables.read_counts(spark, path)


@query(
    "read_lines",
    """
    WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS t,
                      generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM conversations)
    SELECT CAST(row_number() OVER (ORDER BY conv_id, turn, i) - 1 AS BIGINT) AS line_no, t AS text FROM l
    """,
)
def _lines(spark, sf):
    path = new_path(spark)
    c = text_table(spark, sf, "conversations", "conv_id", "turn")
    each = c.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("i", "t"))
    lines.write_lines(each, path, ["conv_id", "turn", "i"], F.col("t"))
    return lines.read_lines(spark, path).select("line_no", "text")


CONLL = f"""
    ev AS (SELECT *, dense_rank() OVER (ORDER BY seq) - 1 AS sent_id FROM ({EVENT_TAGS_SQL}))
"""


def written_tags(spark, sf, compression="none") -> str:
    path = new_path(spark)
    ev = tagged_events(spark, sf).withColumn("word", F.concat(F.lit("e"), F.col("event_id").cast("string")))
    conll.write_tagged(ev, path, ["word", "gold", "pred"], compression=compression)
    return path


@query(
    "read_conll",
    f"""
    WITH {CONLL} SELECT CAST(sent_id AS BIGINT) AS sent_id, CAST(pos AS BIGINT) AS pos, 'e' || event_id AS token,
      pred AS tag FROM ev
    """,
)
def _conll(spark, sf):
    return conll.read_conll(spark, written_tags(spark, sf, "gzip"))


@query(
    "read_tag_pairs",
    f"WITH {CONLL} SELECT CAST(sent_id AS BIGINT) AS sent_id, CAST(pos AS BIGINT) AS pos, gold, pred FROM ev",
)
def _tag_pairs(spark, sf):
    return conll.read_tag_pairs(spark, written_tags(spark, sf))


@query("count_sentences", "SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n FROM events")
def _count_sentences(spark, sf):
    path = new_path(spark)
    ev = tagged_events(spark, sf)
    # A folder per hash part holds whole sentences; each of its files is counted by itself.
    parts = ev.withColumn("part", F.pmod(F.xxhash64("seq"), F.lit(4)))
    laid = parts.select(
        "part",
        "seq",
        "pos",
        F.explode(F.when(F.col("pos") == 0, F.array(F.lit(""), F.col("gold"))).otherwise(F.array("gold"))).alias("line"),
    )
    n = spark.sparkContext.defaultParallelism
    (
        laid.repartition(n, "seq")
        .sortWithinPartitions("part", "seq", "pos", "line")
        .select("part", F.col("line").alias("value"))
        .write.partitionBy("part")
        .text(path)
    )
    return conll.count_sentences(spark, f"{path}/*/*.txt").agg(F.sum("n").alias("n"))


@query(
    "write_tagged",
    f"""
    WITH {CONLL}, l AS (SELECT seq, pos, 0 AS k, '' AS t FROM ev WHERE pos = 0 AND sent_id > 0
      UNION ALL SELECT seq, pos, 1 AS k, gold AS t FROM ev)
    SELECT CAST(row_number() OVER (ORDER BY seq, pos, k) - 1 AS BIGINT) AS line_no, t AS text FROM l
    """,
)
def _write_tagged(spark, sf):
    path = new_path(spark)
    conll.write_tagged(tagged_events(spark, sf), path, ["gold"])
    return lines.read_lines(spark, path).select("line_no", "text")


@query(
    "read_lexicon",
    f"WITH {EDGES} SELECT 'w' || head AS head, 'w' || nb AS neighbour FROM ed",
)
def _lexicon(spark, sf):
    path = new_path(spark)
    name = lambda c: F.concat(F.lit("W"), F.col(c).cast("string"))
    heads = label_edges(spark, sf).groupBy("head").agg(
        F.array_sort(F.collect_list(name("neighbour"))).alias("ns")
    )
    # An older entry of every head comes first and must be overruled.
    entries = heads.select(
        "head", F.explode(F.array(F.array(F.lit("old")), F.col("ns"))).alias("ns")
    ).withColumn("age", F.when(F.array_contains("ns", "old"), 0).otherwise(1))
    lines.write_lines(entries, path, ["age", "head"], F.concat_ws(" ", name("head"), F.array_join("ns", " ")))
    return tables.read_lexicon(spark, path)


@query(
    "read_vectors",
    f"""
    WITH {VEC}, r AS (SELECT vec_id, list_transform(v, lambda x: CAST(format('{{:.4f}}', x) AS DOUBLE)) AS v FROM vec)
    SELECT CAST(vec_id AS VARCHAR) AS word, round(v[1] / sqrt(list_inner_product(v, v) + 1e-6), 6) AS first,
           round(list_sum(v) / sqrt(list_inner_product(v, v) + 1e-6), 6) AS total FROM r
    """,
)
def _vectors(spark, sf):
    path = new_path(spark)
    tables.write_vectors(id_vectors(spark, sf).withColumn("vec", F.col("vec").cast("array<double>")), path)
    return tables.read_vectors(spark, path).select(
        "word",
        F.round(F.get("vec", 0), 6).alias("first"),
        F.round(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x), 6).alias("total"),
    )


@query(
    "write_vectors",
    f"""
    WITH {VEC} SELECT vec_id || ' ' || array_to_string(list_transform(v, lambda x: format('{{:.4f}}', x)), ' ') || ' '
      AS line FROM vec
    """,
)
def _write_vectors(spark, sf):
    path = new_path(spark)
    tables.write_vectors(id_vectors(spark, sf).withColumn("vec", F.col("vec").cast("array<double>")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(
    "read_lexsub_queries",
    """
    SELECT vec_id AS qid, CAST(vec_id % 3 AS BIGINT) AS target_idx,
           'w' || vec_id || ' w' || (vec_id + 1) || ' w' || (vec_id + 2) || ' w' || (vec_id + 3) || ' w' || (vec_id + 4)
             AS sentence FROM embeddings
    """,
)
def _lexsub_queries(spark, sf):
    path = new_path(spark)
    line = F.concat_ws("\t", F.col("target_idx").cast("string"), F.array_join("tokens", " "))
    lines.write_lines(sentences(spark, sf), path, ["qid"], line)
    return tables.read_lexsub_queries(spark, path).select(
        "qid", F.col("target_idx").cast("bigint").alias("target_idx"), F.array_join("tokens", " ").alias("sentence")
    )


@query(
    "read_lexsub_gold",
    """
    SELECT vec_id AS qid, 'w' || vec_id || '.n' AS target, 'a' || label || ' b' || label AS gold FROM embeddings
    """,
)
def _lexsub_gold(spark, sf):
    path = new_path(spark)
    e = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("string").alias("l"))
    words = F.concat_ws(" ", F.concat(F.lit("a"), "l"), F.concat(F.lit("b"), "l"), F.concat(F.lit("a"), "l"))
    line = F.concat_ws("\t", F.concat(F.lit("w"), F.col("vec_id").cast("string"), F.lit(".n")), words)
    lines.write_lines(e, path, ["vec_id"], line)
    return tables.read_lexsub_gold(spark, path).select("qid", "target", F.array_join("gold", " ").alias("gold"))


@query(
    "read_squad",
    f"""
    SELECT CAST(doc_id AS VARCHAR) AS qid, md5(text) AS context,
           CAST(CASE WHEN few THEN 0 ELSE 1 END AS BIGINT) AS n_answers, few AS is_impossible
    FROM (SELECT *, len({qa_tok('text')}) < 7 AS few FROM documents)
    """,
)
def _squad(spark, sf):
    path = new_path(spark)
    r = squad_rows(spark, sf)
    qas = F.array(F.struct(F.col("qid").cast("string").alias("id"), "question", "is_impossible", "answers"))
    article = F.struct(F.array(F.struct("context", qas.alias("qas"))).alias("paragraphs"))
    r.select(F.to_json(F.struct(F.array(article).alias("data"))).alias("value")).write.text(path)
    back = qa_json.read_squad(spark, path, lines=True)
    return back.select(
        "qid",
        F.md5("context").alias("context"),
        F.size("answers").cast("bigint").alias("n_answers"),
        "is_impossible",
    )


@query(
    "read_nq",
    """
    SELECT CAST(page_id AS VARCHAR) AS example_id, url AS question_text, md5(html) AS document, CAST(2 AS BIGINT) AS ls
    FROM pages
    """,
)
def _nq(spark, sf):
    path = new_path(spark)
    rows = nq_rows(spark, sf).withColumn("example_id", F.col("example_id").cast("string"))
    rows.write.json(path)
    first = F.get("annotations", 0)["long_answer"]["start_token"]
    return qa_json.read_nq(spark, path).select(
        "example_id", "question_text", F.md5("document_text").alias("document"), first.cast("bigint").alias("ls")
    )


MODELS = ("bert", "albert", "distilbert", "albertAug", "albertGoogle")
MODEL_BEST = f"""
    nb AS ({NBEST_SQL}),
    rk AS (SELECT *, row_number() OVER (PARTITION BY qid, model ORDER BY event_id DESC) AS rank FROM nb)
"""


@query(
    "read_predictions",
    f"""
    WITH {MODEL_BEST} SELECT model, CAST(qid AS VARCHAR) AS qid, CAST(rank AS BIGINT) AS rank, text,
      round(probability, 6) AS probability FROM rk
    """,
)
def _predictions(spark, sf):
    path = new_path(spark)
    ranked = nbest_events(spark, sf)
    order = Window.partitionBy("qid", "model").orderBy(F.desc("event_id"))
    none = F.lit(None).cast("double")
    top = (
        ranked.withColumn("rank", F.row_number().over(order))
        .withColumn("start_logit", none)
        .withColumn("end_logit", none)
    )
    for model in MODELS:
        qa_json.write_predictions(top.where(F.col("model") == model), f"{path}/{model}_1.json")
    return qa_json.read_predictions(spark, path, lines=True).select(
        "model",
        "qid",
        F.col("rank").cast("bigint").alias("rank"),
        "text",
        F.round("probability", 6).alias("probability"),
    )


@query(
    "write_predictions",
    f"WITH {MODEL_BEST} SELECT model, CAST(qid AS VARCHAR) AS qid, text FROM rk WHERE rank = 1",
)
def _write_predictions(spark, sf):
    path = new_path(spark)
    best = cut_lineage(
        nbest_events(spark, sf).groupBy("model", "qid").agg(F.max_by("text", "event_id").alias("text"))
    )
    for model in MODELS:
        own = best.where(F.col("model") == model).drop("model")
        qa_json.write_predictions(own, f"{path}/{model}_1.json", "best", rows_per_object=50)
    return qa_json.read_predictions(spark, path, "best", lines=True).select("model", "qid", "text")


@query(
    "read_bitext",
    f"""
    WITH {PAIRS}
    SELECT CAST(pair_id AS BIGINT) AS pair_id, array_to_string(src, ' ') AS src, array_to_string(tgt, ' ') AS tgt
    FROM bt
    """,
)
def _bitext(spark, sf):
    c = text_table(spark, sf, "conversations", "conv_id", "turn").withColumn(
        "flat", F.array_join(T.tokens(F.col("text")), " ")
    )
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("flat").alias("u"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("flat").alias("a"))
    both = u.join(a, ["conv_id", "turn"])
    src, tgt = new_path(spark), new_path(spark)
    lines.write_lines(both, src, ["conv_id", "turn"], F.col("u"))
    lines.write_lines(both, tgt, ["conv_id", "turn"], F.col("a"))
    return tables.read_bitext(spark, src, tgt).select(
        "pair_id", F.array_join("src", " ").alias("src"), F.array_join("tgt", " ").alias("tgt")
    )
