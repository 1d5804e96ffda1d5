"""Scores of many runs against gold test sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import strip, tokens
from lexiloom.operators.bitext import corpus_bleu
from lexiloom.operators.ordered import positions
from lexiloom.operators.segment import segmentation_fscore
from lexiloom.operators.tags import chunk_scores, chunk_spans
from lexiloom.operators.vectors import hit_precision

METRICS = ("segmentation", "hits", "chunks", "bleu")
WITHOUT_BLANKS = ("chunks", "bleu")  # blank lines separate sequences there; elsewhere they are lines


def _lines(df: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Stripped lines that count for the metric, numbered again."""
    full = df.withColumn("text", strip(F.col("text")))
    full = full.where(F.col("text") != "") if metric in WITHOUT_BLANKS else full
    return positions(full, keys, ["line_no"], "__no").drop("line_no").withColumnRenamed("__no", "line_no")


def score_runs(
    gold: DataFrame, runs: DataFrame, run_names: DataFrame, metric: str, check_length: bool = True
) -> DataFrame:
    """One score per run and test set: (run, testset, score).

    ``gold`` is (testset, line_no, text), ``runs`` (run, testset, line_no, text)
    and ``run_names`` (run), so that a run without output is scored too. Blank
    lines count for segmentation and hits only. A prediction is cut to the length
    of the gold; a missing one scores 0, and so does a shorter one unless
    ``check_length`` is false. Precision of hits is given times 100.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    by = ["run", "testset"]
    golds = _lines(gold, ["testset"], metric)
    preds = _lines(runs, by, metric)
    sizes = golds.groupBy("testset").agg(F.count(F.lit(1)).alias("__n"))
    fitting = (
        preds.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("__m"))
        .join(sizes, "testset")
        .where((F.col("__m") >= F.col("__n")) | F.lit(not check_length))
        .select(*by, "__n")
    )
    pred = preds.join(fitting, by).where(F.col("line_no") < F.col("__n")).drop("__n")
    ref = golds.join(fitting.select(*by), "testset")
    if metric == "segmentation":
        scores = segmentation_fscore(ref, pred, tuple(by)).select(*by, F.col("f1").alias("score"))
    elif metric == "bleu":
        scores = corpus_bleu(ref, pred, by=by).select(*by, F.col("bleu").alias("score"))
    elif metric == "hits":
        known = ref.select(
            *by, F.col("line_no").alias("qid"), tokens(F.split_part("text", F.lit("\t"), F.lit(2))).alias("gold")
        )
        guessed = pred.select(*by, F.col("line_no").alias("qid"), tokens(F.col("text")).alias("guesses"))
        scores = hit_precision(known, guessed, by=by).select(*by, (100 * F.col("precision")).alias("score"))
    else:
        seq = F.struct(*by).alias("seq")
        spans = [chunk_spans(s.select(seq, F.col("line_no").alias("pos"), F.col("text").alias("tag"))) for s in (ref, pred)]
        flat = [s.select(*[F.col(f"seq.{c}").alias(c) for c in by], "start", "end", "type") for s in spans]
        scores = chunk_scores(*flat, keys=by, by=by).select(*by, F.col("f1").alias("score"))
    # Every run is scored on every test set: the pairs are the report itself.
    wanted = run_names.select("run").join(sizes.select("testset"))
    return wanted.join(scores, by, "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
