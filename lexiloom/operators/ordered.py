"""Running totals and positions over an order, without one task per key.

A window over a key sorts the whole key in one task. Here the rows are cut into
range blocks of equal size first, so a key that holds a third of all rows spans
many blocks. Totals of the blocks are few (one row per key and block) and are
accumulated by an ordinary window; the rows of a block add to that offset.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.session import cut_lineage


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    blocks: int | None = None,
) -> DataFrame:
    """Add inclusive running sums, per ``keys`` in ascending ``order``.

    ``keys`` + ``order`` must identify a row. The block layout is written to
    the shared checkpoint folder because it is read twice and a range cut is
    sampled anew each time it is computed.
    """
    keys, order = list(keys), list(order)
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = list(totals)
    laid = cut_lineage(
        df.select("*", *[totals[t].alias(f"__v_{t}") for t in names])
        .repartitionByRange(n, *keys, *order)
        .withColumn("__block", F.spark_partition_id())
    )
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid.groupBy(*keys, "__block")
        .agg(*[F.sum(f"__v_{t}").alias(f"__s_{t}") for t in names])
        .select(*keys, "__block", *[F.sum(f"__s_{t}").over(before).alias(f"__o_{t}") for t in names])
    )
    inside = (
        Window.partitionBy(*keys, "__block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Every row is in a block, so the block number joins; keys may be null.
    offsets = offsets.withColumnsRenamed({k: f"__r_{k}" for k in [*keys, "__block"]})
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__r_{k}`")) for k in [*keys, "__block"]]
    zero = {t: F.lit(0).cast(laid.schema[f"__v_{t}"].dataType) for t in names}
    return laid.join(offsets, same).select(
        *df.columns,
        *[
            (F.coalesce(F.col(f"__o_{t}"), zero[t]) + F.sum(f"__v_{t}").over(inside)).alias(t)
            for t in names
        ],
    )


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos", start: int = 0,
    blocks: int | None = None,
) -> DataFrame:
    """Number the rows of each key from ``start`` in ascending ``order``."""
    out = running_totals(df, keys, order, {name: F.lit(1).cast("bigint")}, blocks)
    return out.withColumn(name, F.col(name) - 1 + start)
