"""Exact duplicates: frequent digests by Misra-Gries, the rest by an ordinary shuffle.

1. Every row gets the SHA-256 of its text and a row number; these small columns
   are written once.
2. ``freqItems`` is the Misra-Gries summary of Karp, Schenker and Papadimitriou:
   it holds every digest with more than ``support`` of the rows, in at most
   1/support entries, and its partial summaries merge.
3. A second pass counts the candidates exactly and finds the row that stays.
   Only digests that really exceed the support are winners, so at most
   1/support rows are broadcast, whatever the size of the corpus.
4. Rows of a winner get their answer on the map side and are never shuffled.
   The rest is shuffled by digest; a group there holds at most ``support`` of
   the rows.

Defined results: a null text counts as empty, an empty text is a text like any
other. Of equal texts the row with the largest id stays; of rows that agree in
text and id exactly one stays. Null ids are smallest. Other columns, whatever
their names, pass through; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.store import empty_if_null, partitions, stored


def digest(text: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(empty_if_null(text).cast("binary"), 256))


def heavy_digests(digests: DataFrame, support: float) -> DataFrame:
    """Digests of column ``d`` that hold more than ``support`` of the rows, with
    their count and the row (largest ``id``, then largest ``r``) that stays."""
    found = digests.select(F.hex("d").alias("d")).freqItems(["d"], support)
    candidates = found.select(F.explode("d_freqItems").alias("x")).select(F.unhex("x").alias("d"))
    total = digests.agg((F.count(F.lit(1)) * support).alias("least"))
    return (
        digests.join(F.broadcast(candidates), "d", "left_semi")
        .groupBy("d")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "r")).alias("top"))
        .join(F.broadcast(total), F.col("n") > F.col("least"))
        .select("d", "n", "top")
    )


def classes_and_winners(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    support: float | None = None,
    also: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(one row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 and the
    columns ``also``; the heavy digests).

    ``support`` defaults to a quarter of one shuffle partition's share, so that
    no group left to the shuffle outweighs the partition it lands in.
    """
    share = support or max(1 / (4 * partitions(docs)), 1e-4)
    more = dict(also or {})
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"), digest(F.col(text_col)).alias("d"), *[c.alias(n) for n, c in more.items()]
        ).withColumn("r", F.monotonically_increasing_id())
    )
    # Written once as well: both branches below ask whether a digest is heavy.
    heavy = stored(heavy_digests(rows, share))
    here = rows.join(F.broadcast(heavy), "d")
    group = Window.partitionBy("d")
    rest = (
        rows.join(F.broadcast(heavy), "d", "left_anti")
        .withColumn("n", F.count(F.lit(1)).over(group))
        .withColumn("top", F.max(F.struct("id", "r")).over(group))
    )
    columns = ["id", "r", "d", "n", "top", *more]
    classes = here.select(*columns).unionByName(rest.select(*columns)).select(
        F.col("id").alias(id_col),
        F.col("top.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("r") == F.col("top.r")).alias("kept"),
        F.lower(F.hex("d")).alias("text_sha256"),
        *more,
    )
    return classes, heavy


def duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float | None = None
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    return classes_and_winners(docs, id_col, text_col, support)[0]


def drop_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float | None = None
) -> DataFrame:
    """``docs`` with one whole row for every distinct text, all columns kept.

    Rows of a heavy digest are dropped on the map side unless they may be the
    row that stays (equal id); everything else is shuffled by digest once.
    """
    share = support or max(1 / (4 * partitions(docs)), 1e-4)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"),
        digest(F.col(text_col)).alias("d"),
    )
    rows = stored(keyed.select("id", "d").withColumn("r", F.lit(0)))
    winners = F.broadcast(stored(heavy_digests(rows, share)).select("d", F.col("top.id").alias("keep")))
    left = keyed.join(winners, "d", "left").where(F.col("keep").isNull() | F.col("id").eqNullSafe(F.col("keep")))
    best = Window.partitionBy("d").orderBy(F.col("id").desc_nulls_last())
    return left.withColumn("k", F.row_number().over(best)).where("k = 1").select("row.*")
