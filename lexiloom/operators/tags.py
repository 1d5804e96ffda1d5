"""Chunks of tag sequences (IOB2 and IOBES) and their scores.

A sequence is rows (seq, pos, tag) with consecutive positions. Work on a
sequence is done in slabs of consecutive positions, so one very long sequence
is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.text import noisy_token, split_tag
from lexiloom.operators.ordered import positions
from lexiloom.operators.skew import lookup_join

SLAB = 65536


def flatten_sequences(df: DataFrame, seq: str = "seq", pos: str = "pos") -> DataFrame:
    """Glue all sequences into one, in (seq, pos) order, ignoring their borders."""
    glued = positions(df, [], [seq, pos], "__at")
    return glued.drop(seq, pos).withColumn(seq, F.lit(0)).withColumnRenamed("__at", pos)


def noise_tokens(df: DataFrame, seed: int, key: str = "seq", tokens: str = "tokens", drop_tail: bool = False) -> DataFrame:
    """Add noise to the training sentences of a tagger: every token of three or more
    letters is kept, loses an inner letter or has one swapped with the letter after it.

    What happens follows from the integer ``key`` of the sentence, the place of the
    token and ``seed``, so a run can be repeated and a lost task redone.
    """
    row = F.col(key).cast("bigint")

    def one(token: Column, i: Column) -> Column:
        action = F.pmod(row * 31 + i * 17 + seed, F.lit(3))
        at = F.lit(1) + F.pmod(row * 13 + i * 29 + seed, F.greatest(F.length(token) - 2, F.lit(1)))
        return noisy_token(token, action, at.cast("int"), drop_tail)

    return df.withColumn(tokens, F.transform(tokens, one))


def chunk_boundaries(
    df: DataFrame, tag: str = "tag", seq: str = "seq", pos: str = "pos", slab: int = SLAB
) -> DataFrame:
    """Add ``type``, ``starts`` (a chunk starts at this token) and ``ends`` (the
    chunk of the token before ended there).

    The last token of a slab is copied into the next slab, where it only serves
    as the previous token.
    """
    here = F.floor(F.col(pos) / slab)
    is_last = F.pmod(F.col(pos), F.lit(slab)) == slab - 1
    slots = F.when(is_last, F.array(here, here + 1)).otherwise(F.array(here))
    laid = df.withColumn("__slab", F.explode(slots)).withColumn("__t", split_tag(F.col(tag)))
    order = Window.partitionBy(seq, "__slab").orderBy(pos)
    prev = F.coalesce(F.lag("__t").over(order), F.struct(F.lit("O").alias("prefix"), F.lit(None).alias("type")))
    before, now = F.col("__prev"), F.col("__t")
    inside = before["prefix"] != "O"
    cut = (
        ~before["type"].eqNullSafe(now["type"])
        | now["prefix"].isin("B", "S")
        | before["prefix"].isin("E", "S")
    )
    return (
        laid.withColumn("__prev", prev)
        .where(F.col("__slab") == here)
        .withColumn("type", now["type"])
        .withColumn("starts", (now["prefix"] != "O") & (~inside | cut))
        .withColumn("ends", inside & ((now["prefix"] == "O") | cut))
        .drop("__t", "__prev", "__slab")
    )


def chunk_spans(df: DataFrame, tag: str = "tag", seq: str = "seq", pos: str = "pos", slab: int = SLAB) -> DataFrame:
    """One row per chunk: (seq, start, end, type); both ends inclusive."""
    flagged = (
        chunk_boundaries(df.select(seq, pos, tag), tag, seq, pos, slab)
        .where(F.col("type").isNotNull())
        .withColumn("__slab", F.floor(F.col(pos) / slab))
    )
    so_far = Window.partitionBy(seq, "__slab").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    pieces = (
        flagged.withColumn("start", F.max(F.when(F.col("starts"), F.col(pos))).over(so_far))
        .groupBy(seq, "__slab", "start")
        .agg(F.max(pos).alias("end"), F.max("type").alias("type"))
    )
    # A piece without a start goes on with the last chunk of an earlier slab.
    earlier = Window.partitionBy(seq).orderBy("__slab").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        pieces.groupBy(seq, "__slab")
        .agg(F.max("start").alias("__last"))
        .select(seq, "__slab", F.max("__last").over(earlier).alias("__from"))
    )
    carried = carried.select(F.col(seq).alias("__seq"), F.col("__slab").alias("__at"), "__from")
    same = F.col(seq).eqNullSafe(F.col("__seq")) & (F.col("__slab") == F.col("__at"))
    joined = pieces.join(carried, same).withColumn("start", F.coalesce("start", "__from"))
    return joined.groupBy(seq, "start").agg(F.max("end").alias("end"), F.max("type").alias("type"))


def _rates(correct: Column, predicted: Column, gold: Column) -> list[Column]:
    p = F.when(predicted > 0, correct / predicted).otherwise(0.0)
    r = F.when(gold > 0, correct / gold).otherwise(0.0)
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return [(100 * p).alias("precision"), (100 * r).alias("recall"), (100 * f1).alias("f1")]


def chunk_counts(gold: DataFrame, pred: DataFrame, keys: Sequence[str] = ("seq",), by: Sequence[str] = ()) -> DataFrame:
    """Gold, predicted and correct chunks of two span tables, per ``by``.

    One shuffle: both sides are stacked and grouped by the whole span.
    """
    whole = [*dict.fromkeys([*keys, "start", "end", "type", *by])]
    sides = gold.select(*whole, F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(
        pred.select(*whole, F.lit(0).alias("g"), F.lit(1).alias("p"))
    )
    spans = sides.groupBy(*whole).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return spans.groupBy(*by).agg(
        total(F.col("g")).alias("gold"),
        total(F.col("p")).alias("predicted"),
        total(F.col("g") * F.col("p")).alias("correct"),
    )


def chunk_scores(gold: DataFrame, pred: DataFrame, keys: Sequence[str] = ("seq",), by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 (times 100) over chunks with equal start, end and type."""
    counts = chunk_counts(gold, pred, keys, by)
    return counts.select("*", *_rates(F.col("correct"), F.col("predicted"), F.col("gold")))


def chunk_report(gold: DataFrame, pred: DataFrame, keys: Sequence[str] = ("seq",)) -> DataFrame:
    """The same per chunk type, sorted by type."""
    return chunk_scores(gold, pred, keys, ["type"]).orderBy("type")


def tag_accuracy(df: DataFrame, gold: str = "gold", pred: str = "pred") -> DataFrame:
    """Token accuracy and accuracy over tokens whose gold tag is not O, times 100."""
    right = F.when(F.col(gold) == F.col(pred), 100.0).otherwise(0.0)
    return df.agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.avg(right).alias("accuracy"),
        F.avg(F.when(F.col(gold) != "O", right)).alias("accuracy_inside"),
    )


def argmax_index(scores: Column) -> Column:
    """0-based index of the largest score, the first one on ties."""
    return F.array_position(scores, F.array_max(scores)) - 1


def argmax_label(df: DataFrame, labels: DataFrame, scores: str = "scores", *, spread: Sequence[str]) -> DataFrame:
    """Add the label (ix, label) of the largest score."""
    best = df.withColumn("ix", argmax_index(F.col(scores)))
    return lookup_join(best, labels.select("ix", "label"), ["ix"], "left", spread=spread)
