"""Text lines with stable numbers, without reading a file in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiloom.functions.text import strip
from lexiloom.operators.skew import is_small
from lexiloom.session import cut_lineage

SLAB = 65536
MAX_BLOCKS = 1_000_000  # block offsets sent to all tasks, below the byte bound of ``is_small``


def read_lines(spark: SparkSession, path: str | list[str], per_file: bool = False) -> DataFrame:
    """Lines of text files: (file, line_no, text); gzip files are read as well.

    Large files are read in blocks. Inside a block the reading order gives the
    number, and the line counts of the blocks before it (one row per block)
    give the offset. Numbers run on over all files in name order, as for the
    part files of one written table, or start anew with ``per_file``.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"),
        F.col("value").alias("text"),
    )
    blocks = raw.groupBy("file", "__block").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    # The window holds one row per block of input, some hundred megabytes of text each.
    # Part files of one table go by their number, which may outgrow its five digits.
    part = F.regexp_extract("file", r"/part-(\d+)[^/]*$", 1).try_cast("bigint")
    order = Window.partitionBy("file").orderBy("__block") if per_file else Window.orderBy(part, "file", "__block")
    before = F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # Written once: the text is read a second time only to be numbered, and not
    # shuffled for that unless its blocks are too many to send.
    offsets = cut_lineage(blocks.select("file", "__block", "__first", F.coalesce(before, F.lit(0)).alias("__before")))
    offsets = F.broadcast(offsets) if is_small(offsets, MAX_BLOCKS) else offsets
    return raw.join(offsets, ["file", "__block"]).select(
        "file", (F.col("__before") + F.col("__id") - F.col("__first")).alias("line_no"), "text"
    )


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def number_sentences(lines: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Lines between blank lines as sentences: adds (sent_id, pos), drops blank lines.

    The lines of a key are worked on in slabs of consecutive numbers. The last
    line of a slab is copied into the next one as the line before it, and the
    sentence counts of earlier slabs are carried over as one row per slab.
    """
    keys = list(keys)
    here = F.floor(F.col("line_no") / SLAB)
    is_last = F.pmod(F.col("line_no"), F.lit(SLAB)) == SLAB - 1
    laid = lines.withColumn("__blank", is_blank(F.col("text"))).withColumn(
        "__slab", F.explode(F.when(is_last, F.array(here, here + 1)).otherwise(F.array(here)))
    )
    order = Window.partitionBy(*keys, "__slab").orderBy("line_no")
    flagged = (
        laid.withColumn("__prev", F.coalesce(F.lag("__blank").over(order), F.lit(True)))
        .where(F.col("__slab") == here)
        .withColumn("__starts", ~F.col("__blank") & F.col("__prev"))
    )
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = flagged.withColumn("__in", F.sum(F.col("__starts").cast("bigint")).over(so_far)).withColumn(
        "__from", F.max(F.when(F.col("__starts"), F.col("line_no"))).over(so_far)
    )
    earlier = Window.partitionBy(*keys).orderBy("__slab").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        flagged.groupBy(*keys, "__slab")
        .agg(
            F.count_if("__starts").alias("__c"),
            F.max(F.when(F.col("__starts"), F.col("line_no"))).alias("__l"),
        )
        .select(
            *keys,
            "__slab",
            F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__base"),
            F.max("__l").over(earlier).alias("__open"),
        )
    )
    return (
        counted.where(~F.col("__blank"))
        .join(carried, [*keys, "__slab"])
        .withColumn("sent_id", F.col("__base") + F.col("__in") - 1)
        .withColumn("pos", F.col("line_no") - F.coalesce("__from", "__open"))
        .drop("__slab", "__blank", "__prev", "__starts", "__in", "__from", "__base", "__open")
    )


def write_lines(df: DataFrame, path: str, order: Sequence[str], line: Column, compression: str = "none") -> None:
    """Write one text line per row in ``order``; the part files in name order are the text."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select(line.alias("value"))
        .write.option("compression", compression)
        .text(path)
    )
