"""Column files: one token per line, blank lines between sentences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.text import tokens
from lexiloom.sources.lines import is_blank, number_sentences, read_lines, write_lines


def _column(cols: Column, index: int) -> Column:
    """Entry ``index``, from the end if negative; a missing one is an error."""
    value = F.get(cols, index) if index >= 0 else F.get(cols, F.size(cols) + index)
    return F.coalesce(
        value, F.raise_error(F.concat(F.lit("too few columns in line: "), F.array_join(cols, " "))).cast("string")
    )


def _sentences(spark: SparkSession, path: str, per_file: bool) -> DataFrame:
    lines = read_lines(spark, path, per_file)
    numbered = number_sentences(lines, ["file"] if per_file else [])
    keep = ["file", "sent_id", "pos"] if per_file else ["sent_id", "pos"]
    return numbered.select(*keep, tokens(F.col("text")).alias("__cols"))


def read_conll(
    spark: SparkSession, path: str, input_idx: int = 0, label_idx: int = 2, per_file: bool = False
) -> DataFrame:
    """(sent_id, pos, token, tag); without the tag if ``label_idx`` is negative.

    With ``per_file`` every file is a text of its own and ``file`` is added.
    """
    rows = _sentences(spark, path, per_file)
    out = rows.withColumn("token", _column(F.col("__cols"), input_idx))
    if label_idx >= 0:
        out = out.withColumn("tag", _column(F.col("__cols"), label_idx))
    return out.drop("__cols")


def read_tag_pairs(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    """The last two columns as gold and predicted tag: (sent_id, pos, gold, pred).
    Lines need three columns."""
    rows = _sentences(spark, path, per_file)
    third = _column(F.col("__cols"), 2)
    return (
        rows.withColumn("gold", F.when(third.isNotNull(), _column(F.col("__cols"), -2)))
        .withColumn("pred", _column(F.col("__cols"), -1))
        .drop("__cols")
    )


def count_sentences(spark: SparkSession, path: str) -> DataFrame:
    """Sentences per file: (file, n). An empty file counts 1, and so does the
    empty start of a file that begins with two blank lines."""
    lines = read_lines(spark, path, per_file=True)
    blank = is_blank(F.col("text"))
    lead = lines.groupBy("file").agg(
        (F.count_if(blank & (F.col("line_no") < 2)) == 2).alias("__lead"), F.count_if(~blank).alias("__full")
    )
    starts = number_sentences(lines).where(F.col("pos") == 0).groupBy("file").agg(F.count(F.lit(1)).alias("__n"))
    # A scan does not visit empty files. Spark's file index, which the driver holds
    # for every read, has their names.
    names = [(name,) for name in spark.read.text(path).inputFiles()]
    files = spark.createDataFrame(names, "__path string")
    key = lambda c: F.regexp_replace(c, "^file:/+", "/")
    counted = lead.join(starts, "file", "left").select(
        key("file").alias("__key"),
        (F.coalesce("__n", F.lit(0)) + F.when(F.col("__lead") & (F.col("__full") > 0), 1).otherwise(0)).alias("__n"),
    )
    return files.withColumn("__key", key("__path")).join(counted, "__key", "left").select(
        F.col("__path").alias("file"), F.greatest(F.coalesce("__n", F.lit(1)), F.lit(1)).alias("n")
    )


def write_tagged(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = ("tag",),
    seq: str = "seq",
    pos: str = "pos",
    compression: str = "none",
) -> None:
    """One token per line, a blank line before every sentence but the first.

    Rows are sorted by range, so a sentence is never collected and the part
    files in name order are the text. Positions start at 0.
    """
    text = F.concat_ws(" ", *columns)
    first = df.agg(F.min(seq)).scalar()
    rows = df.withColumn("__text", text).withColumn("__first", first)
    opened = F.when(
        (F.col(pos) == 0) & (F.col(seq) != F.col("__first")), F.array(F.lit(""), F.col("__text"))
    ).otherwise(F.array("__text"))
    laid = rows.select(seq, pos, F.posexplode(opened).alias("__k", "__line"))
    write_lines(laid, path, [seq, pos, "__k"], F.col("__line"), compression)
