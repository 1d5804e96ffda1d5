"""Queries of the corpus operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import (
    alignment,
    best_fit,
    exact_dedup,
    mixing,
    packing,
    pii,
    quality_rules,
    secrets_scan,
    simhash_dedup,
    spelling,
    suffix_dedup,
    token_files,
    url_filter,
)
from lexiloom.llm.store import scratch
from lexiloom.llm.words import tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
VOCABULARY = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures; the tables have no fetch time, so the day follows from the id."""
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.expr("date_add(DATE'2024-01-01', CAST(pmod(page_id * 37, 366) AS INT))").alias("day")
    )


def list_entries(captures: DataFrame) -> DataFrame:
    """A dated list log made from the hosts of the captures: spam hosts come, go and
    come back; blogs' parent domains are listed for half a year; one language of a
    host is listed as a URL prefix."""
    hosts = captures.select(url_filter.host_of(F.col("url")).alias("host"), "day").where("host IS NOT NULL")
    hosts = hosts.groupBy("host").agg(F.min("day").alias("d0"))
    row = lambda rule, category, day, added: F.struct(
        rule.alias("rule"), F.lit(category).alias("category"), day.alias("day"), F.lit(added).alias("added")
    )
    host, parent = F.concat(F.lit("d:"), F.col("host")), F.regexp_replace("host", "^[^.]*[.]", "")
    date = lambda text: F.lit(text).cast("date")
    none = F.array().cast("array<struct<rule:string,category:string,day:date,added:boolean>>")
    spam = F.when(
        F.col("host").rlike("spam|pills|casino"),
        F.array(
            row(host, "spam", F.date_add("d0", 30), True),
            row(host, "spam", F.date_add("d0", 150), False),
            row(host, "spam", F.date_add("d0", 240), True),
        ),
    ).otherwise(none)
    blog = F.when(
        F.col("host").like("blog.%") & (F.length("host") % 3 == 0),
        F.array(
            row(F.concat(F.lit("d:"), parent), "blogs", date("2024-03-01"), True),
            row(F.concat(F.lit("d:"), parent), "blogs", date("2024-09-01"), False),
        ),
    ).otherwise(none)
    prefix = F.array(row(F.concat(F.lit("u:"), F.col("host"), F.lit("/de")), "language", date("2024-06-01"), True))
    return hosts.select(F.inline(F.concat(spam, blog, prefix))).distinct()


@query(
    "op1_url_filter",
    r"""
    WITH c AS (
      SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INT) AS day,
             lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS host,
             regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)?', 1) AS path
      FROM pages),
    h AS (SELECT host, min(day) AS d0 FROM c WHERE host <> '' GROUP BY host),
    intervals AS (
      SELECT host AS name, 'spam' AS category, d0 + 30 AS since, d0 + 150 AS until FROM h WHERE regexp_matches(host, 'spam|pills|casino')
      UNION ALL SELECT host, 'spam', d0 + 240, NULL FROM h WHERE regexp_matches(host, 'spam|pills|casino')
      UNION ALL SELECT DISTINCT regexp_replace(host, '^[^.]*[.]', ''), 'blogs', DATE '2024-03-01', DATE '2024-09-01'
                FROM h WHERE host LIKE 'blog.%' AND length(host) % 3 = 0),
    names AS (
      SELECT DISTINCT page_id, array_to_string(list_slice(string_split(host, '.'), k, len(string_split(host, '.'))), '.') AS name
      FROM c, unnest(range(1, len(string_split(host, '.')) + 1)) AS u(k) WHERE host <> ''),
    hits AS (
      SELECT page_id, category FROM names JOIN c USING (page_id) JOIN intervals i USING (name)
      WHERE since <= day AND (until IS NULL OR day < until)
      UNION SELECT page_id, 'language' FROM c
      WHERE host <> '' AND day >= DATE '2024-06-01' AND (path = '/de' OR path LIKE '/de/%')),
    listed AS (SELECT page_id, string_agg(category, ',' ORDER BY category) AS listed FROM hits GROUP BY page_id)
    SELECT page_id, url, day, coalesce(listed, '') AS listed, listed IS NULL AS kept
    FROM c LEFT JOIN listed USING (page_id)
    """,
)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = page_captures(spark, sf_dir)
    out = url_filter.filter_urls(captures, list_entries(captures))
    return out.withColumn("listed", F.array_join("listed", ","))


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(documents(spark, sf_dir))


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is taken for the owner, its texts of one language for a repository."""
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", F.col("source").alias("owner"), F.concat_ws("/", "source", "lang").alias("repo")
    )
    return secrets_scan.scan(docs)


@query(
    "op4_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_classes(documents(spark, sf_dir))


@query("op5_simple8b")
def op5_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    token_files.write(documents(spark, sf_dir), path, tokenizer_path(VOCABULARY))
    return token_files.read(spark, path)


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path(VOCABULARY))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(documents(spark, sf_dir))


@query("op11_best_fit")
def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(documents(spark, sf_dir), tokenizer_path(VOCABULARY))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.align(documents(spark, sf_dir), a, b)[0]


@query("op13_spelling")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))
