"""Line-aligned translation data and corpus BLEU."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from lexiloom.operators.ordered import positions

ORDERS = 4


def filter_bitext(
    df: DataFrame,
    max_len: int = 50,
    limit: int | None = None,
    predicate: Callable[[DataFrame], Column] | None = None,
) -> DataFrame:
    """Pairs (pair_id, src, tgt) whose sides both have at most ``max_len``
    tokens, and that pass ``predicate``; of the first ``limit`` lines if one is given."""
    missing = {"pair_id", "src", "tgt"} - set(df.columns)
    if missing:
        raise ValueError(f"columns not found in the input: {sorted(missing)}")
    out = df if limit is None else df.where(F.col("pair_id") < limit)
    out = out.where((F.size("src") <= max_len) & (F.size("tgt") <= max_len))
    return out.where(predicate(out)) if predicate else out


def length_buckets(df: DataFrame, batch: int = 64) -> DataFrame:
    """Number batches of pairs with similar source length: adds ``bucket``."""
    sized = df.withColumn("__len", F.size("src"))
    placed = positions(sized, [], ["__len", "pair_id"], "__at")
    return placed.withColumn("bucket", F.floor(F.col("__at") / batch)).drop("__len", "__at")


def corpus_bleu(
    ref: DataFrame, hyp: DataFrame, keys: Sequence[str] = ("line_no",), by: Sequence[str] = ()
) -> DataFrame:
    """Corpus BLEU of lower-cased, white-space tokenised lines (keys, text).

    Clipped 1- to 4-gram precisions, a brevity penalty, and halving smoothing of
    zero counts: (bleu, ref_len, hyp_len, p1 .. p4). Lines are matched on ``keys``.
    """
    line = [*by, *[k for k in keys if k not in by]]
    nothing = F.lit(None).cast("string")
    sides = ref.select(*line, F.col("text").alias("r"), nothing.alias("h")).unionByName(
        hyp.select(*line, nothing.alias("r"), F.col("text").alias("h"))
    )
    for c in line:  # null keys match nothing
        sides = sides.where(F.col(c).isNotNull())
    # Texts are shuffled, n-grams are not: both sides of a line meet in one row and are compared there.
    met = sides.groupBy(*line).agg(F.collect_list("r").alias("r"), F.collect_list("h").alias("h"))
    lower = lambda c: F.transform(c, F.lower)
    both = met.where((F.size("r") > 0) & (F.size("h") > 0)).select(*by, _line_counts(lower("r"), lower("h")).alias("__c"))
    flat = both.select(*by, *[F.get("__c", i).alias(name) for i, name in enumerate(_COUNTS)])
    some = flat.where((F.col("__r1") > 0) | (F.col("__t1") > 0))
    total = some.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in _COUNTS])
    # Zero matches at order n count as 1 / (2^j * total), j being the number of
    # zero orders so far; orders without n-grams give 0.
    zeros = F.lit(0)
    precision = []
    for n in range(1, ORDERS + 1):
        c, t = F.col(f"__c{n}"), F.col(f"__t{n}")
        zeros = zeros + F.when((t > 0) & (c == 0), 1).otherwise(0)
        precision.append(
            F.when(t == 0, 0.0).when(c == 0, 100.0 / (F.pow(F.lit(2.0), zeros) * t)).otherwise(100.0 * c / t)
        )
    ref_len, hyp_len = F.col("__r1"), F.col("__t1")
    brevity = F.when(hyp_len >= ref_len, 1.0).when(hyp_len > 0, F.exp(1 - ref_len / hyp_len)).otherwise(0.0)
    product = sum((F.log(p) for p in precision[1:]), F.log(precision[0])) / ORDERS
    some_zero = F.least(*precision) <= 0
    return total.select(
        *by,
        F.when(some_zero, 0.0).otherwise(brevity * F.exp(product)).alias("bleu"),
        ref_len.cast("bigint").alias("ref_len"),
        hyp_len.cast("bigint").alias("hyp_len"),
        *[p.alias(f"p{i}") for i, p in enumerate(precision, 1)],
    )


_COUNTS = [f"__{c}{n}" for n in range(1, ORDERS + 1) for c in "ctr"]


@F.pandas_udf(ArrayType(LongType()))
def _line_counts(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    """Per order the clipped matches and the n-grams of both sides of a line, whose texts are two
    arrays. Where a line has several, each text meets each of the other side. ``str.split``
    cuts where ``tokens`` does."""

    def counted(r: Sequence[str], h: Sequence[str]) -> list[int]:
        out, sides = [], [[t.split() for t in side] for side in (r, h)]
        for n in range(1, ORDERS + 1):
            a, b = (Counter(g for t in side for g in zip(*[t[i:] for i in range(n)])) for side in sides)
            shared = sum(min(len(h) * k, len(r) * b[g]) for g, k in a.items() if g in b)
            out += [shared, len(r) * b.total(), len(h) * a.total()]
        return out

    return pd.Series([counted(r, h) for r, h in zip(ref, hyp)], dtype="object")
