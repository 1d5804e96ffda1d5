"""Mix sources to target weights: exact block quotas split over shards, then disjoint draws.

Every source is cut into blocks by a hash of the row. A target above the size of
its source takes every document once and draws the rest; below it only draws.
The draw takes whole blocks in a permuted order; in the one block that the
target cuts, finer cells and then documents are taken while they fit, and the
smallest one left if that is nearer, so a source misses its target by at most
half of the smallest document left out there.

The blocks that were drawn are dealt over ``shards`` (a power of two) by a
multivariate-hypergeometric splitting tree: at each node a uniformly random half
of the node's blocks goes left, which fixes an exact quota of every source for
either side, level by level. Blocks of a source then fill its shard quotas in
permuted order, so draws are disjoint, and rows are shuffled inside their shard
by a hash. Randomness is a hash of values and a seed: reruns agree.

The number of shards follows the bytes of text, so a shard stays of a size that
one task sorts. The block table holds ``shards * blocks_per_shard`` rows plus one
per source; documents meet it by (source, block).

Defined results: a null or empty text has size 0 and is taken once if its source
takes every document once, else with its block. A null source is a source of its
own, last in order. Repeated rows are separate rows that share their draw. A very
long text is one row of one shard. Extra columns pass through; an empty table gives
an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.store import WORD, empty_if_null, stored
from lexiloom.operators.skew import is_small

WEIGHTS = (5, 2, 1)
CELL_DOCS = 256
SHARD_BYTES = 256 << 20  # text of a shard, at most, which one task sorts
LEAST_SHARDS = 64


def n_words(text: Column) -> Column:
    return F.regexp_count(empty_if_null(text), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Target of every source of ``sizes`` (src, source_size, docs).

    Targets are weight times one common level, but at most ``cap`` times the
    size. Giving the excess to the others by weight until nobody is above ends
    at that level: with the sources in order of cap over weight, it is the first
    level that no further source exceeds. One row per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", w.cast("double")).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    everyone = Window.partitionBy(F.lit(0))
    by_fill = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    level = (F.sum("source_size").over(everyone) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), zero)) / (
        F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), zero)
    )
    fits = ranked.withColumn("level", level).withColumn(
        "common", F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct((F.col("most") / F.col("weight")).alias("fill"), "rank", "level"))).over(everyone)
    )
    return fits.select(
        "src", "rank", "source_size", "docs",
        F.coalesce(F.least("most", F.col("common.level") * F.col("weight")), F.col("most")).alias("target"),
    )


def split_over_shards(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """Quotas (rank, shard, quota) from one row per drawn block (rank, block, copy).

    Sampling half of a node's blocks without replacement is a multivariate
    hypergeometric draw of its sources' counts. The nodes of the first level are
    one table of a bounded number of rows.
    """
    nodes = blocks.select("rank", "block", "copy", F.lit(0).alias("node"))
    for level in range(shards.bit_length() - 1):
        inside = Window.partitionBy("node")
        order = inside.orderBy(F.xxhash64("rank", "block", "copy", F.lit(level), F.lit(seed)), "rank", "block", "copy")
        nodes = nodes.select(
            "rank", "block", "copy", "node", F.row_number().over(order).alias("i"), F.count(F.lit(1)).over(inside).alias("m")
        ).select(
            "rank", "block", "copy",
            # the odd block of a node goes to either side in turn
            (F.col("node") * 2 + (F.col("i") > F.floor((F.col("m") + F.col("node") % 2) / 2)).cast("int")).alias("node"),
        )
    return nodes.groupBy("rank", F.col("node").alias("shard")).agg(F.count(F.lit(1)).alias("quota"))


def assign_blocks(blocks: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """Shard of every drawn block: permuted blocks of a source fill its quotas in turn."""
    place = Window.partitionBy("rank").orderBy(F.xxhash64("block", "copy", F.lit(seed)), "block", "copy")
    ends = Window.partitionBy("rank").orderBy("shard")
    ranges = quotas.withColumn("hi", F.sum("quota").over(ends)).select(
        "rank", F.explode(F.sequence(F.col("hi") - F.col("quota") + 1, F.col("hi"))).alias("i"), "shard"
    )
    return (
        blocks.select("rank", "block", "copy", F.row_number().over(place).cast("bigint").alias("i"))
        .join(ranges, ["rank", "i"])
        .select("rank", "block", "copy", "shard")
    )


@dataclass(frozen=True)
class Draw:
    """The tables that decide how often and where a document is taken."""

    plan: DataFrame  # a row per source: rank, target, full passes, words still needed, blocks, cells
    blocks: DataFrame  # a row per block: whole, cut, words left for the cut block
    cells: DataFrame  # a row per cell of a cut block
    fitted: DataFrame  # documents taken from each source's cut cell
    shards: DataFrame  # a row per drawn block and copy, with its shard

    def annotate(self, rows: DataFrame) -> DataFrame:
        """``rows`` (src, h and any others) with rank, block, source_size, target and ``copies``.

        Rows of blocks that are not cut, nearly all, are decided where they lie.
        """
        keep = [*rows.columns, "rank", "block", "source_size", "target"]
        at = located(rows, self.plan).join(checked(self.blocks.drop("full")), ["rank", "block"])
        plain = at.where("NOT cut").select(*keep, (F.col("full") + F.col("whole").cast("int")).alias("copies"))
        cut = (
            at.where("cut")
            .join(self.cells.drop("cell_left"), ["rank", "block", "cell"])
            .join(self.fitted, (F.col("rank") == F.col("frank")) & (F.col("h") == F.col("fh")), "left")
            .select(*keep, (F.col("full") + (F.col("cell_whole") | F.col("fh").isNotNull()).cast("int")).alias("copies"))
        )
        return plain.unionByName(cut)


def checked(side: DataFrame) -> DataFrame:
    """A table of about one row per source or block: broadcast if its checked size allows it, else shuffled."""
    return F.broadcast(side) if is_small(side) else side


def located(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the entries of their source's plan, their block and their cell."""
    side = plan.select(F.col("src").alias("__s"), *[c for c in plan.columns if c not in ("src", "docs")])
    return (
        rows.join(checked(side), F.col("src").eqNullSafe(F.col("__s")))
        .withColumn("block", F.pmod("h", "blocks").cast("int"))
        .withColumn("cell", F.pmod(F.xxhash64("h"), "cells").cast("int"))
        .drop("__s", "blocks", "cells")
    )


def _bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).alias("bytes")


def keyed(docs: DataFrame, id_col: str, source_col: str, seed: int) -> list[Column]:
    return [F.col(source_col).cast("string").alias("src"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("h")]


def shards_for(rows: DataFrame, share: float) -> int:
    """The power of two that brings a shard of the mix to ``SHARD_BYTES`` of text at most, ``LEAST_SHARDS`` or more."""
    held = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    return max(LEAST_SHARDS, 1 << max(0, math.ceil(held * share / SHARD_BYTES) - 1).bit_length())


def draw(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    shards: int | None = None,
    blocks_per_shard: int = 16,
    seed: int = 7,
) -> Draw:
    """Decide the mix of ``rows`` (src, h, size, bytes), a small table that is read several times.

    Without ``shards`` there are as many as bring a shard to about ``SHARD_BYTES`` of
    text, so a shard does not grow with the corpus. The tree works on its blocks, a row
    each; its first levels sort that table in few tasks.
    """
    shards = shards or shards_for(rows, share)
    if shards & (shards - 1) or shards < 1:
        raise ValueError("shards must be a power of two")
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    n_blocks = shards * blocks_per_shard
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    in_blocks = F.ceil(F.col("source_size") * n_blocks / F.greatest(total, F.lit(1)))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
    plan = stored(
        source_targets(sizes, weights, share, cap)
        # at most its share of the blocks, and no block of less than a cell of documents
        .withColumn("blocks", F.least(F.greatest(F.lit(1), in_blocks), F.ceil(F.col("docs") / CELL_DOCS)).cast("int"))
        .withColumn("cells", F.ceil(F.col("docs") / F.col("blocks") / CELL_DOCS).cast("int"))
        .withColumn("full", passes.cast("int"))
        .withColumn("need", F.round(F.col("target") - F.col("full") * F.col("source_size")).cast("bigint"))
    )
    at = located(rows, plan)
    # Cumulated sizes: blocks of a source, cells of its cut block, documents of its cut cell.
    cells = stored(at.groupBy("rank", "need", "full", "block", "cell").agg(F.sum("size").alias("size")))
    permuted = Window.partitionBy("rank").orderBy(F.xxhash64("block", F.lit(seed)), "block")
    whole = F.col("end") <= F.col("need")
    left = F.col("need") - F.col("end") + F.col("size")
    blocks = stored(
        cells.groupBy("rank", "need", "full", "block")
        .agg(F.sum("size").alias("size"))
        .withColumn("end", F.sum("size").over(permuted))
        .select("rank", "full", "block", whole.alias("whole"), (~whole & (left > 0)).alias("cut"), left.alias("left"))
    )
    in_block = Window.partitionBy("rank", "block").orderBy("cell")
    cell_left = F.col("left") - F.col("end") + F.col("size")
    cut_cells = stored(
        cells.drop("full", "need")
        .join(checked(blocks.where("cut").select("rank", "block", "left")), ["rank", "block"])
        .withColumn("end", F.sum("size").over(in_block))
        .select("rank", "block", "cell", (F.col("end") <= F.col("left")).alias("cell_whole"), cell_left.alias("cell_left"))
    )
    fitted = stored(_fit_cell(at, cut_cells.where("NOT cell_whole AND cell_left > 0")))
    copies = F.col("full") + (F.col("whole") | F.col("cut")).cast("int")
    taken = stored(
        blocks.withColumn("n", copies).where("n > 0").select("rank", "block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    )
    return Draw(plan, blocks, cut_cells, fitted, stored(assign_blocks(taken, split_over_shards(taken, shards, seed), seed)))


def _fit_cell(at: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows (frank, fh) of each source's cut cell that still fit, largest first.

    One cell per source, of about ``CELL_DOCS`` documents."""
    inside = (
        at.join(checked(cells.select("rank", "block", "cell", "cell_left")), ["rank", "block", "cell"])
        .groupBy("rank", "cell_left", "h")
        .agg(F.sum("size").alias("size"))
        .groupBy("rank", "cell_left")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("neg"), "h"))).alias("rows"))
    )
    fitting = F.aggregate(
        "rows",
        F.struct(F.col("cell_left").alias("left"), F.array().cast("array<bigint>").alias("hs")),
        lambda s, x: F.when(
            -x["neg"] <= s["left"],
            F.struct((s["left"] + x["neg"]).alias("left"), F.concat(s["hs"], F.array(x["h"])).alias("hs")),
        ).otherwise(s),
    )
    # The smallest document left over is taken too if that ends nearer to the target.
    over = F.element_at(F.filter("rows", lambda x: (x["neg"] < 0) & ~F.array_contains("f.hs", x["h"])), -1)
    nearer = -over["neg"] < 2 * F.col("f.left")
    taken = F.when(nearer, F.concat("f.hs", F.array(over["h"]))).otherwise(F.col("f.hs"))
    return inside.withColumn("f", fitting).select(F.col("rank").alias("frank"), F.explode(taken).alias("fh"))


def taken_words(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 7, **how
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken words, copies and block,
    with the shard and the place in it of every copy, as in ``mix``."""
    rows = stored(docs.select(F.col(id_col).alias("id"), *keyed(docs, id_col, source_col, seed), n_words(F.col(text_col)).alias("size"), _bytes(F.col(text_col))))
    plan = draw(rows, seed=seed, **how)
    drawn = plan.shards.groupBy("rank", "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("drawn"))
    placed = plan.annotate(rows).join(checked(stored(drawn)), ["rank", "block"], "left").withColumn(
        "drawn", F.filter(F.coalesce("drawn", F.array().cast("array<struct<copy:int,shard:int>>")), lambda d: d["copy"] < F.col("copies"))
    )
    return placed.select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.size("drawn") * F.col("size")).alias("taken"), "copies", "block",
        F.col("drawn.shard").alias("shards"),
        F.transform("drawn", lambda d: F.xxhash64("h", d["copy"], F.lit(seed))).alias("places"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 7, **how
) -> DataFrame:
    """Whole rows of ``docs``, repeated as drawn, with ``shard`` and ``place`` added
    (in place of columns of these names, in any case). Every partition holds whole shards, each
    in the order of its places."""
    rows = stored(docs.select(*keyed(docs, id_col, source_col, seed), n_words(F.col(text_col)).alias("size"), _bytes(F.col(text_col))))
    plan = draw(rows, seed=seed, **how)
    names = [c for c in docs.columns if c.lower() not in ("shard", "place")]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *keyed(docs, id_col, source_col, seed))
    copies = plan.annotate(whole).where("copies > 0").select(
        "row", "h", "rank", "block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    )
    placed = copies.join(checked(plan.shards), ["rank", "block", "copy"]).select(
        "row.*", "shard", F.xxhash64("h", "copy", F.lit(seed)).alias("place")
    )
    return placed.repartition("shard").sortWithinPartitions("shard", "place")
