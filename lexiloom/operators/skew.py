"""Equi-joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def hot_keys(df: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more rows than a task should get, and the number of parts to cut each into.

    A task should get ``rows_per_task`` rows, or an even share of all rows over
    the shuffle partitions if that is more. So there are at most as many hot keys
    as partitions, which bounds what is broadcast, and no key is left whole that
    outweighs an average task.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = df.agg((F.count(F.lit(1)) / partitions).alias("share")).scalar()
    n, limit = F.col("__n"), F.greatest(F.lit(float(rows_per_task)), share)
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).withColumn("__limit", limit)
    return counts.where(n > F.col("__limit")).select(*on, F.ceil(n / F.col("__limit")).cast("int").alias("__fan"))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread: Sequence[str | Column] = (),
    rows_per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Inner, left, semi or anti join of a big ``left`` with ``right`` on equal keys.

    Rows of a hot left key are dealt over several tasks by a hash of the
    ``spread`` columns, which must tell rows of equal keys apart, and the
    matching right rows are repeated for each of those tasks. All other keys join
    as usual. The deal depends on values only, so a task that is run again after
    a lost executor deals the same way. ``null_safe`` lets null keys match.

    Finding the hot keys reads ``left`` once more. Where several joins follow
    each other, pass ``hot`` found on the first input, so that the reads add up
    instead of doubling with every join.
    """
    on = list(on)
    _check_spread(on, spread)
    hot = hot_keys(left.select(*on), on, rows_per_task) if hot is None else hot
    dealt, repeated = deal(left, hot, on, spread), repeat(right, hot, on)
    if not null_safe:
        return dealt.join(repeated, on + ["__part"], how).drop("__part")
    return _join_null_safe(dealt, repeated, [*on, "__part"], how).drop("__part")


def _check_spread(on: Sequence[str], spread: Sequence[str | Column]) -> None:
    if not spread or all(isinstance(c, str) and c in on for c in spread):
        raise ValueError(f"spread must name columns that tell rows of equal keys {list(on)} apart")


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null equals null; the keys of ``left`` stay."""
    other = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`__r_{c}`")) for c in on]
    return left.join(other, same, how).drop(*[f"__r_{c}" for c in on])


MAX_LOOKUP_ROWS = 200_000
MAX_LOOKUP_BYTES = 64 << 20


def is_small(df: DataFrame, rows: int | None = None) -> bool:
    """Whether a table of plain columns is within the broadcast bounds, by reading
    at most one row more than allowed."""
    most = MAX_LOOKUP_ROWS if rows is None else rows
    width = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) * 4 + 16 for c in df.columns), F.lit(0))
    seen = df.limit(most + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return seen["n"] <= most and (seen["b"] or 0) <= MAX_LOOKUP_BYTES


def lookup_join(
    left: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", *, spread: Sequence[str | Column],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join with a table that is often small: broadcast if its checked size
    allows it, else ``spread_join``. For tables that are cheap to read."""
    _check_spread(on, spread)
    if is_small(table):
        return left.join(F.broadcast(table), list(on), how)
    return spread_join(left, table, on, how, spread, hot=hot)


def deal(left: DataFrame, hot: DataFrame, on: Sequence[str], spread: Sequence[str | Column]) -> DataFrame:
    """The big side with ``__part``: which of its key's parts a row goes to."""
    parts = F.coalesce(F.col("__fan"), F.lit(1))
    return (
        _join_null_safe(left, F.broadcast(hot), list(on), "left")
        .withColumn("__part", F.pmod(F.xxhash64(*spread), parts).cast("int"))
        .drop("__fan")
    )


def repeat(right: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    """The other side with one copy of each row per part of its key."""
    parts = F.coalesce(F.col("__fan"), F.lit(1))
    return (
        _join_null_safe(right, F.broadcast(hot), list(on), "left")
        .withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("__fan")
    )
