"""Combining the predictions of several models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.operators.skew import lookup_join


def _weighted(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Rows of known models with their weight. The weight table has one row per
    model; it is broadcast once its size is checked, since a few models hold all rows."""
    return lookup_join(rows, weights.select("model", "weight"), ["model"], "inner", spread=[c for c in rows.columns if c != "model"])


def unknown_models(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Number of rows per model that has no weight; those rows take no part."""
    per_model = rows.groupBy("model").agg(F.count(F.lit(1)).alias("n"))
    return per_model.join(weights.select("model"), "model", "left_anti")


def _best_text(rows: DataFrame, score: Column) -> DataFrame:
    """Sum the score per (qid, text), keep the best text; ties go to the smaller text."""
    sums = rows.groupBy("qid", "text").agg(F.round(F.sum(score), 9).alias("score"))
    best = sums.groupBy("qid").agg(F.min(F.struct((-F.col("score")).alias("neg"), "text")).alias("b"))
    return best.select("qid", F.col("b.text").alias("text"), (-F.col("b.neg")).alias("score"))


def ensemble_vote(nbest: DataFrame, weights: DataFrame) -> DataFrame:
    """Best text per question by the summed model weights of its occurrences."""
    return _best_text(_weighted(nbest, weights), F.col("weight"))


def ensemble_probability_sum(nbest: DataFrame, weights: DataFrame) -> DataFrame:
    """Best text per question by the summed probability times model weight."""
    return _best_text(_weighted(nbest, weights), F.col("probability") * F.col("weight"))


def seeded_draw(seed: int) -> Callable[[Column, Column], Column]:
    """A number in [0, 1) from the question and the step, the same on every run."""
    return lambda qid, step: F.pmod(F.xxhash64(F.lit(seed), qid, step), F.lit(1 << 30)) / float(1 << 30)


def ensemble_stochastic(
    preds: DataFrame,
    weights: DataFrame,
    p: float = 0.85,
    draw: Callable[[Column, Column], Column] | None = None,
    run: str = "model",
) -> DataFrame:
    """Fold the predictions of a question in ``run`` order: keep the one held if
    its model weighs more and the draw is below ``p``, else take the next.

    A run predicts a question once, so a question has as many entries as there
    are runs; repeated rows of a run are reduced to one before they are collected.
    """
    u = draw or seeded_draw(0)
    once = (
        _weighted(preds, weights)
        .groupBy("qid", F.col(run).alias("__run"))
        .agg(F.max(F.struct("text", "weight")).alias("v"))
    )
    lists = once.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("__run", F.col("v.weight").alias("w"), F.col("v.text").alias("t")))).alias(
            "xs"
        )
    )
    steps = F.transform(
        F.slice("xs", F.lit(2), F.size("xs")),
        lambda x, i: F.struct(x["w"].alias("w"), x["t"].alias("t"), u(F.col("qid"), i + 1).alias("u")),
    )
    first = F.get(F.col("xs"), 0)
    final = F.aggregate(
        steps,
        F.struct(first["w"].alias("w"), first["t"].alias("t")),
        lambda held, x: F.when((held["w"] > x["w"]) & (x["u"] < p), held).otherwise(
            F.struct(x["w"].alias("w"), x["t"].alias("t"))
        ),
        lambda held: held["t"],
    )
    return lists.select("qid", final.alias("text"))
