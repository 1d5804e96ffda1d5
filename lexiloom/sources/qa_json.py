"""Question-answering JSON files and prediction files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.sources.json_ranges import array_items, object_entries

ARTICLE = (
    "struct<paragraphs: array<struct<context: string, qas: array<struct<id: string, question: string, "
    "is_impossible: boolean, answers: array<struct<text: string, answer_start: int>>>>>>>"
)
SQUAD_SCHEMA = f"data array<{ARTICLE}>"
_TOKENS = "struct<start_token: int, end_token: int>"
NQ_SCHEMA = (
    "example_id string, question_text string, document_text string, "
    f"annotations array<struct<long_answer: {_TOKENS}, short_answers: array<{_TOKENS}>>>"
)
NBEST_ENTRY = "array<struct<text: string, probability: double, start_logit: double, end_logit: double>>"
KINDS = {"nbest": f"map<string, {NBEST_ENTRY}>", "best": "map<string, string>", "na_prob": "map<string, double>"}


def read_squad(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per question: (qid, question, context, answers, is_impossible).

    A file is one JSON object, of any size: its articles are read by many tasks.
    With ``lines`` every line is an object.
    """
    if lines:
        articles = spark.read.schema(SQUAD_SCHEMA).option("mode", "FAILFAST").json(path).select(F.explode("data").alias("a"))
    else:
        articles = array_items(spark, path, "data").select(F.from_json("text", ARTICLE, {"mode": "FAILFAST"}).alias("a"))
    paragraphs = articles.select(F.explode("a.paragraphs").alias("p"))
    questions = paragraphs.select("p.context", F.explode("p.qas").alias("q"))
    return questions.select(
        F.col("q.id").alias("qid"),
        "q.question",
        "context",
        "q.answers",
        F.coalesce("q.is_impossible", F.lit(False)).alias("is_impossible"),
    )


def read_nq(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of long and short answers given as token offsets."""
    return spark.read.schema(NQ_SCHEMA).option("mode", "FAILFAST").json(path)


def read_predictions(spark: SparkSession, path: str, kind: str = "nbest", lines: bool = False) -> DataFrame:
    """Prediction maps keyed by question, of all ``*.json`` files or folders in ``path``.

    ``kind`` is ``nbest`` (model, qid, rank, text, probability, start_logit,
    end_logit), ``best`` (model, qid, text) or ``na_prob`` (model, qid, na_prob).
    The model is the name up to the first underscore, ``run`` the whole name. A file is
    one object, of any size: its entries are read by many tasks. With ``lines`` every line
    is an object, as ``write_predictions`` leaves them.
    """
    if lines:
        text = spark.read.text(f"{path}/*.json").select(F.col("_metadata.file_path").alias("file"), "value")
    else:
        text = object_entries(spark, f"{path}/*.json").select("file", F.concat(F.lit("{"), "text", F.lit("}")).alias("value"))
    name = F.regexp_extract("file", r"([^/]+)\.json(?:/[^/]+)?$", 1)
    entries = text.select(
        F.substring_index(name, "_", 1).alias("model"),
        name.alias("run"),
        F.explode(F.from_json("value", KINDS[kind], {"mode": "FAILFAST"})).alias("qid", "v"),
    )
    if kind == "best":
        return entries.withColumnRenamed("v", "text")
    if kind == "na_prob":
        return entries.withColumnRenamed("v", "na_prob")
    ranked = entries.select("model", "run", "qid", F.posexplode("v").alias("p", "e"))
    return ranked.select("model", "run", "qid", (F.col("p") + 1).alias("rank"), "e.*")


def write_predictions(df: DataFrame, path: str, kind: str = "nbest", rows_per_object: int | None = None) -> None:
    """Write prediction maps as JSON text: one object per question and line.

    With ``rows_per_object`` questions are gathered by hash into objects of about
    that many entries, one per line; one object with everything is never built.
    """
    if kind == "nbest":
        # An n-best list is short by construction.
        values = df.groupBy("qid").agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "text", "probability", "start_logit", "end_logit"))),
                lambda e: F.struct(e["text"], e["probability"], e["start_logit"], e["end_logit"]),
            ).alias("v")
        )
    else:
        values = df.select("qid", F.col("text" if kind == "best" else "na_prob").alias("v"))
    keyed = values.select(F.col("qid").cast("string").alias("qid"), "v")
    if kind == "nbest":
        keyed = keyed.withColumn("v", F.col("v").cast(NBEST_ENTRY))
    if rows_per_object is None:
        objects = keyed.select(F.to_json(F.create_map("qid", "v")).alias("value"))
    else:
        n = max(1, -(-keyed.count() // rows_per_object))
        grouped = keyed.groupBy(F.pmod(F.xxhash64("qid"), F.lit(n)).alias("__o")).agg(
            F.map_from_entries(F.collect_list(F.struct("qid", "v"))).alias("m")
        )
        objects = grouped.select(F.to_json("m").alias("value"))
    objects.write.text(path)
