"""Answer scoring: exact match, token F1, no-answer thresholds and curves.

A question is one row (qid, answers array<string>), a prediction one row
(qid, text). Scores of a question are computed inside its row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lexiloom.functions.arrays import bag_overlap, bind, compute_once
from lexiloom.functions.text import normalize_answer, tokens
from lexiloom.operators.ordered import running_totals
from lexiloom.session import cut_lineage

DIGITS = 9  # running sums that agree to nine decimals count as ties


def exact_match(pred: Column, gold: Column) -> Column:
    """1.0 if both strings are equal after normalising, else 0.0."""
    return (normalize_answer(pred) == normalize_answer(gold)).cast("double")


def _f1(p: Column, g: Column, empty_agrees: bool) -> Column:
    """F1 of two token arrays. With ``empty_agrees`` two empty sides score 1."""
    overlap = bag_overlap(p, g)
    none = F.when((F.size(p) == 0) & (F.size(g) == 0), 1.0).otherwise(0.0) if empty_agrees else F.lit(0.0)
    return F.when((F.size(p) == 0) | (F.size(g) == 0), none).otherwise(
        bind(overlap, lambda n: 2.0 * n / (F.size(p) + F.size(g)))
    )


def token_f1(pred: Column, gold: Column, empty_agrees: bool = False) -> Column:
    """Bag-overlap F1 of the normalised tokens of two strings."""
    sides = F.struct(
        tokens(normalize_answer(pred)).alias("p"), tokens(normalize_answer(gold)).alias("g")
    )
    return bind(sides, lambda s: _f1(s["p"], s["g"], empty_agrees))


LONG = 10_000  # tokens of both sides together from which on a row's bags are counted by a shuffle


def token_f1_rows(
    df: DataFrame,
    keys: Sequence[str],
    pred: str = "pred",
    gold: str = "gold",
    empty_agrees: bool = False,
    long_tokens: int = LONG,
) -> DataFrame:
    """(keys, f1) of every row, as ``token_f1``, for texts of any length.

    ``keys`` identify a row. Rows of fewer than ``long_tokens`` tokens are scored where
    they are. The tokens of longer ones are counted by (row, token), so that the two bags
    of a row are never sorted in it. A null text gives a null score.
    """
    keys = list(keys)
    clean = [normalize_answer(F.col(c)).alias(name) for c, name in ((pred, "__p"), (gold, "__g"))]
    size = lambda c: F.when(F.col(c) == "", 0).otherwise(F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1)
    counted = lambda d: compute_once(d, keys, *clean).select("*", size("__p").alias("__np"), size("__g").alias("__ng"))
    n, both_there = F.col("__np") + F.col("__ng"), (F.col("__np") > 0) & (F.col("__ng") > 0)
    is_long = F.coalesce((n >= long_tokens) & both_there, F.lit(False))
    none = F.when((F.col("__np") == 0) & (F.col("__ng") == 0), 1.0).otherwise(0.0) if empty_agrees else F.lit(0.0)
    f1 = F.when(n.isNull(), None).when(~both_there, none).otherwise(2.0 * F.col("__both") / n)
    short = counted(df).where(~is_long).withColumn("__both", _shared_words("__p", "__g")).select(*keys, f1.alias("f1"))
    # A token takes a character, and another one sets it apart: shorter texts are not even normalised here.
    maybe_long = F.length(pred) + F.length(gold) >= 2 * long_tokens - 2
    marked = lambda c, side: F.transform(F.split(c, " "), lambda t: F.struct(t.alias("t"), F.lit(side).alias("s")))
    long = counted(df.where(maybe_long)).where(is_long)
    each = long.select(*keys, n.alias("__n"), F.explode(F.concat(marked("__p", 1), marked("__g", 0))).alias("x"))
    count = lambda side: F.sum((F.col("x.s") == side).cast("bigint"))
    shared = each.groupBy(*keys, "__n", "x.t").agg(F.least(count(1), count(0)).alias("both"))
    long = shared.groupBy(*keys, "__n").agg(F.sum("both").alias("both")).select(*keys, (2.0 * F.col("both") / F.col("__n")).alias("f1"))
    return short.unionByName(long)


@F.pandas_udf(LongType())
def _shared_words(a: pd.Series, b: pd.Series) -> pd.Series:
    """Size of the bag intersection of the words of two texts with single spaces."""

    def shared(x: str | None, y: str | None) -> int:
        counts, n = Counter(x.split(" ")) if x and y else {}, 0
        for word in y.split(" ") if counts else ():
            left = counts.get(word, 0)
            if left:
                counts[word] = left - 1
                n += 1
        return n

    return pd.Series([shared(x, y) for x, y in zip(a, b)], dtype="int64")


def raw_scores(questions: DataFrame, preds: DataFrame, no_answers: bool = False) -> DataFrame:
    """Best exact match and F1 over the answers of every question.

    Gives (qid, has_answer, text, exact, f1); the last three are null where a
    question has no prediction. With ``no_answers`` answers that normalise to
    nothing are dropped, and a question without answers expects an empty text.
    """
    clean = F.transform("answers", normalize_answer)
    if no_answers:
        kept = F.filter(clean, lambda a: a != "")
        clean = bind(kept, lambda k: F.when(F.size(k) > 0, k).otherwise(F.array(F.lit(""))))
    golds = questions.select("qid", (F.size("answers") > 0).alias("has_answer"), F.array_distinct(clean).alias("__g"))
    sides = compute_once(
        golds.join(preds.select("qid", "text"), "qid", "left"),
        ["qid", "has_answer", "text", "__g"],
        normalize_answer(F.col("text")).alias("__p"),
    )
    exact = F.array_contains("__g", F.col("__p")).cast("double")
    best = bind(
        tokens(F.col("__p")),
        lambda p: F.array_max(F.transform("__g", lambda a: bind(tokens(a), lambda g: _f1(p, g, no_answers)))),
    )
    answered = F.col("text").isNotNull()
    return compute_once(
        sides,
        ["qid", "has_answer", "text"],
        F.when(answered, F.coalesce(exact, F.lit(0.0))).alias("exact"),
        F.when(answered, F.coalesce(best, F.lit(0.0))).alias("f1"),
    )


def evaluate_v1(questions: DataFrame, preds: DataFrame) -> DataFrame:
    """Mean exact match and F1 (times 100) over all questions; unanswered ones score 0."""
    scores = raw_scores(questions, preds)
    return scores.agg(
        (100 * F.avg(F.coalesce("exact", F.lit(0.0)))).alias("exact_match"),
        (100 * F.avg(F.coalesce("f1", F.lit(0.0)))).alias("f1"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("text").isNull()).alias("unanswered"),
    )


def apply_no_answer_threshold(score: Column, na_prob: Column, has_answer: Column, threshold: float = 1.0) -> Column:
    """Where the no-answer probability exceeds the threshold the question
    counts as left unanswered, which is right only if it has no answer."""
    return F.when(F.coalesce(na_prob, F.lit(0.0)) > threshold, (~has_answer).cast("double")).otherwise(score)


def question_table(questions: DataFrame, preds: DataFrame, na: DataFrame | None = None) -> DataFrame:
    """Raw scores with ``na_prob`` and ``answered`` (non-empty prediction)."""
    scores = raw_scores(questions, preds, no_answers=True)
    if na is None:
        scores = scores.withColumn("na_prob", F.when(F.col("text").isNotNull(), 0.0))
    else:
        scores = scores.join(na.select("qid", "na_prob"), "qid", "left")
    return scores.withColumn("answered", F.col("text") != "")


def evaluate_v2(
    questions: DataFrame, preds: DataFrame, na: DataFrame | None = None, threshold: float = 1.0
) -> DataFrame:
    """Scores over predicted questions: overall, with answers, without answers."""
    scored = question_table(questions, preds, na)
    seen = F.col("text").isNotNull()
    cols = []
    for prefix, part in (("", F.lit(True)), ("HasAns_", F.col("has_answer")), ("NoAns_", ~F.col("has_answer"))):
        use = seen & part
        for name in ("exact", "f1"):
            value = apply_no_answer_threshold(F.col(name), F.col("na_prob"), F.col("has_answer"), threshold)
            cols.append((100 * F.avg(F.when(use, value))).alias(prefix + name))
        cols.append(F.count_if(use).alias(prefix + "total"))
    return scored.agg(*cols, F.count_if(~seen).alias("missing"))


def best_threshold(scores: DataFrame, *names: str) -> DataFrame:
    """The no-answer threshold with the best total, for each score column (default
    ``score``): rows (metric, best, threshold, has_answer_mean).

    Takes one row per question (qid, has_answer, answered, na_prob, scores); a
    null score means no prediction. The walk starts from the number of questions
    without an answer and goes up in (na_prob, qid); the start wins ties.
    ``has_answer_mean`` is the mean score of the questions that have an answer.
    All columns share one walk.
    """
    names = names or ("score",)
    has, ranked = F.col("has_answer"), F.col("na_prob").isNotNull()
    lost = F.when(F.col("answered"), -1.0).otherwise(0.0)
    steps = {
        m: F.coalesce(F.when(has, F.col(m)).when(F.col(m).isNotNull(), lost).cast("double"), F.lit(0.0))
        for m in names
    }
    walk = scores.where(ranked).select("na_prob", "qid", *names, *[s.alias(f"s_{m}") for m, s in steps.items()])
    run = running_totals(walk, [], ["na_prob", "qid"], {f"run_{m}": F.col(f"s_{m}") for m in names})
    peaks = run.agg(
        *[
            F.max(
                F.when(
                    F.col(m).isNotNull(),
                    F.struct(F.round(f"run_{m}", DIGITS).alias("run"), (-F.col("na_prob")).alias("neg")),
                )
            ).alias(m)
            for m in names
        ]
    )
    totals = scores.agg(
        F.count_if(~has).cast("double").alias("start"),
        F.count_if(has & ranked).alias("n_has"),
        *[F.count(m).alias(f"n_{m}") for m in names],
        *[F.sum(F.when(has & ranked, F.coalesce(m, F.lit(0.0)))).alias(f"has_{m}") for m in names],
    )
    # Two one-row tables become one row of structs per metric.
    both = totals.withColumn("peaks", peaks.select(F.struct(*names)).scalar())
    rows = []
    for m in names:
        gain = F.col(f"peaks.{m}.run")
        best = 100.0 * (F.col("start") + F.greatest(F.coalesce(gain, F.lit(0.0)), F.lit(0.0))) / F.col(f"n_{m}")
        at = F.when(gain > 0, -F.col(f"peaks.{m}.neg")).otherwise(0.0)
        mean = F.col(f"has_{m}") / F.col("n_has")
        rows.append(
            F.struct(
                F.lit(m).alias("metric"), best.alias("best"), at.alias("threshold"), mean.alias("has_answer_mean")
            )
        )
    return both.select(F.inline(F.array(*rows)))


def _ranking(scores: DataFrame, names: Sequence[str]) -> DataFrame:
    """Running sums over the no-answer ranking, one row per probability.

    Rows of equal probability enter together. The group without a probability
    takes no part in the ranking, only in the count of answers.
    """
    has, ranked = F.col("has_answer"), F.col("na_prob").isNotNull()
    groups = scores.groupBy("na_prob").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(has).alias("pos"),
        *[
            F.sum(F.when(has, F.coalesce(F.col(m).cast("double"), F.lit(0.0))).otherwise(0.0)).alias(f"tp_{m}")
            for m in names
        ],
    )
    totals = {f"all_{m}": F.when(ranked, F.col(f"tp_{m}")).otherwise(0.0) for m in names}
    totals["all_n"] = F.when(ranked, F.col("n")).otherwise(0)
    return running_totals(groups, [], ["na_prob"], totals)


def precision_recall_curve(scores: DataFrame, *names: str) -> DataFrame:
    """Points of the curve, one for each no-answer probability and score column
    (default ``score``): (metric, na_prob, precision, recall)."""
    names = names or ("score",)
    run = cut_lineage(_ranking(scores, names))
    answers = run.agg(F.sum("pos")).scalar()
    points = [
        F.struct(
            F.lit(m).alias("metric"),
            "na_prob",
            (F.col(f"all_{m}") / F.col("all_n")).alias("precision"),
            (F.col(f"all_{m}") / F.col("answers")).alias("recall"),
        )
        for m in names
    ]
    return run.where(F.col("na_prob").isNotNull()).withColumn("answers", answers).select(F.inline(F.array(*points)))


def average_precision(scores: DataFrame, *names: str) -> DataFrame:
    """Average precision over the no-answer ranking, times 100, for each score
    column (default ``score``): rows (metric, ap).

    Rows of equal probability enter together. A tie group adds its precision
    times its share of the true positives. All columns share one pass.
    """
    names = names or ("score",)
    areas = _ranking(scores, names).agg(
        F.sum("pos").alias("pos"),
        *[
            F.sum(F.when(F.col("na_prob").isNotNull(), F.col(f"all_{m}") / F.col("all_n") * F.col(f"tp_{m}"))).alias(m)
            for m in names
        ],
    )
    return areas.select(
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric"), (100.0 * F.col(m) / F.col("pos")).alias("ap")) for m in names])
        )
    )


def na_prob_histogram(scores: DataFrame, bins: int = 20) -> DataFrame:
    """Share of questions per no-answer probability bin on [0, 1], with and
    without answers: (has_answer, bin, share). The last bin includes 1."""
    p = F.col("na_prob")
    width = 1.0 / bins
    guess = F.floor(p * bins)
    exact = F.when(p < guess * width, guess - 1).when(p >= (guess + 1) * width, guess + 1).otherwise(guess)
    counted = (
        scores.where(p.isNotNull())
        .select("has_answer", F.when(p.between(0.0, 1.0), F.least(exact, F.lit(bins - 1))).alias("bin"))
        .groupBy("has_answer", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most bins + 1 rows per side.
    total = F.sum("n").over(Window.partitionBy("has_answer"))
    return counted.withColumn("share", F.col("n") / total).where(F.col("bin").isNotNull()).drop("n")
