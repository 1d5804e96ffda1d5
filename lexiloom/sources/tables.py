"""Count tables, lexicons, word vectors and substitution files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.text import strip, tokens
from lexiloom.functions.vectors import l2_normalize
from lexiloom.sources.lines import read_lines


def read_counts(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """``key sep count`` lines as (gram, cnt); repeated keys are summed. Malformed lines fail."""
    rows = (
        spark.read.schema("gram string, cnt bigint")
        .options(sep=sep, quote="", mode="FAILFAST", enforceSchema="true")
        .csv(path)
    )
    return rows.groupBy("gram").agg(F.sum("cnt").alias("cnt"))


def write_counts(counts: DataFrame, path: str, sep: str = "\t") -> None:
    counts.select(F.concat_ws(sep, "gram", F.col("cnt").cast("string"))).write.text(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``head word word ...`` lines as edges (head, neighbour), lower-cased.
    The last line of a repeated head wins."""
    words = read_lines(spark, path).select("line_no", tokens(F.lower("text")).alias("w")).where(F.size("w") > 0)
    last = words.groupBy(F.get("w", 0).alias("head")).agg(F.max_by("w", "line_no").alias("w"))
    return last.select("head", F.explode(F.slice("w", F.lit(2), F.size("w"))).alias("neighbour"))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``word v1 v2 ...`` lines as (word, vec) with unit length."""
    parts = spark.read.text(path).select(tokens(F.col("value")).alias("p")).where(F.size("p") > 1)
    return parts.select(
        F.get("p", 0).alias("word"),
        l2_normalize(F.slice("p", F.lit(2), F.size("p")).cast("array<double>")).alias("vec"),
    )


def write_vectors(df: DataFrame, path: str) -> None:
    """Write (word, vec) as ``word v1 v2 ...`` lines with four decimals."""
    numbers = F.array_join(F.transform("vec", lambda x: F.format_string("%.4f", x)), " ")
    df.select(F.concat(F.col("word").cast("string"), F.lit(" "), numbers, F.lit(" "))).write.text(path)


def read_lexsub_queries(spark: SparkSession, path: str) -> DataFrame:
    """``index tab sentence`` lines as (qid, target_idx, tokens); the line number is the id."""
    fields = F.split(strip(F.col("text")), "\t")
    return read_lines(spark, path).select(
        F.col("line_no").alias("qid"),
        strip(F.get(fields, 0)).cast("int").alias("target_idx"),
        tokens(F.get(fields, 1)).alias("tokens"),
    )


def read_lexsub_gold(spark: SparkSession, path: str) -> DataFrame:
    """``lemma.pos tab words`` lines as (qid, target, gold)."""
    fields = F.split(strip(F.col("text")), "\t")
    return read_lines(spark, path).select(
        F.col("line_no").alias("qid"),
        F.get(fields, 0).alias("target"),
        F.array_distinct(tokens(F.get(fields, 1))).alias("gold"),
    )


def read_bitext(spark: SparkSession, src: str, tgt: str, limit: int | None = None) -> DataFrame:
    """Two line-aligned texts as (pair_id, src, tgt) token arrays, lower-cased.

    Blank lines before and after a text do not count; the longer text is cut.
    """

    def side(path: str, name: str) -> DataFrame:
        lines = read_lines(spark, path).withColumn("text", strip(F.lower("text")))
        full = F.when(F.col("text") != "", F.col("line_no"))
        # The first and the last line with text, one row.
        edge = lines.agg(F.struct(F.min(full).alias("a"), F.max(full).alias("z"))).scalar()
        inside = lines.withColumn("__e", edge).where(F.col("line_no").between(F.col("__e.a"), F.col("__e.z")))
        return inside.select((F.col("line_no") - F.col("__e.a")).alias("pair_id"), tokens(F.col("text")).alias(name))

    pairs = side(src, "src").join(side(tgt, "tgt"), "pair_id")
    return pairs if limit is None else pairs.where(F.col("pair_id") < limit)
