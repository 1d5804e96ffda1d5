"""The entries of a file that is one JSON object, read by many tasks.

A file is read in byte ranges, as text whose "lines" end at commas; Spark's text reader
finds the first comma of a range by itself. Whether a comma stands inside a string, and
how deep in brackets, depends on all text before it: both are running sums over the file
(quotes, then brackets outside of strings), so no task reads a file from its front. Commas
outside of strings at the depth of the wanted entries are their borders; what lies between
two of them is put together again. A group holds one entry, never the file.

Escapes need no state: a comma cannot follow a backslash in JSON.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.arrays import bind
from lexiloom.operators.ordered import running_totals
from lexiloom.operators.skew import lookup_join

_ORDER = ["block", "id"]


def _bracket_sum(text: Column) -> Column:
    """Opening brackets less closing ones."""
    count = lambda signs: F.length(text) - F.length(F.translate(text, signs, ""))
    return (count("{[") - count("}]")).cast("bigint")


def _chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, id, value, quotes, outer, inner): text up to each comma, its number of
    quotes, and its bracket sums should it begin outside of a string, or inside of one."""
    raw = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    side = lambda p, odd: _bracket_sum(F.array_join(F.filter(p, lambda _, i: i % 2 == odd), ""))
    counts = bind(
        parts,
        lambda p: F.struct((F.size(p) - 1).cast("bigint").alias("quotes"), side(p, 0).alias("outer"), side(p, 1).alias("inner")),
    )
    return raw.select("*", counts.alias("c")).select("file", *_ORDER, "value", "c.*")


def elements(spark: SparkSession, path: str | list[str], depth: int = 1) -> DataFrame:
    """(file, entry, element, last, text): the text between commas at ``depth`` and above.

    Depth 1 gives the entries of the object (``element`` = ``entry``), depth 2 also cuts the
    arrays and objects in them. The text keeps the brackets around it: those that open
    before the first element of an entry, and close behind the last.
    """
    quoted = running_totals(_chunks(spark, path), ["file"], _ORDER, {"seen": F.col("quotes")})
    began_inside = (F.col("seen") - F.col("quotes")) % 2 == 1
    deep = running_totals(
        quoted.select("file", *_ORDER, "value", (F.col("seen") % 2 == 0).alias("outside"), F.when(began_inside, F.col("inner")).otherwise(F.col("outer")).alias("delta")),
        ["file"], _ORDER, {"depth": F.col("delta")},
    )
    cut = lambda at: F.col("outside") & (F.col("depth") > 0) & (F.col("depth") <= at)
    flags = deep.select("file", *_ORDER, "value", "depth", cut(1).cast("bigint").alias("c1"), cut(depth).cast("bigint").alias("cd"))
    cuts = running_totals(flags, ["file"], _ORDER, {"t1": F.col("c1"), "td": F.col("cd")})
    mine = [F.col("file"), (F.col("td") - F.col("cd")).alias("element")]
    gathered = cuts.groupBy(*mine).agg(
        F.min(F.col("t1") - F.col("c1")).alias("entry"),
        F.max(F.col("depth") == 0).alias("last"),  # the object ends in it
        F.array_sort(F.collect_list(F.struct(*_ORDER, "value"))).alias("parts"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["value"]), ",")
    return gathered.select("file", "entry", "element", "last", text.alias("text"))


def _cut_off(text: Column, pattern: str, where: Column) -> Column:
    return F.when(where, F.regexp_replace(text, pattern, "")).otherwise(text)


def object_entries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, entry, text): every entry of the objects, ``"key": value``."""
    each = elements(spark, path)
    body = _cut_off(_cut_off(F.col("text"), r"^\s*\{", F.col("entry") == 0), r"\}\s*$", F.col("last"))
    return each.select("file", "entry", body.alias("text")).where(F.trim(F.regexp_replace("text", r"\s", "")) != "")


def array_items(spark: SparkSession, path: str | list[str], key: str) -> DataFrame:
    """(file, item, text): the items of the array under ``key`` of the objects."""
    each = elements(spark, path, 2)
    opening = r'^\s*\{?\s*"' + re.escape(key) + r'"\s*:\s*\['
    ends = each.groupBy("file", "entry").agg(
        F.min("element").alias("first_item"), F.max("element").alias("last_item"), F.min(F.struct("element", "text"))["text"].rlike(opening).alias("wanted")
    )
    # As many rows as the objects have entries.
    wanted = ends.where("wanted").drop("wanted")
    held = lookup_join(each, wanted, ["file", "entry"], "inner", spread=["element"])
    item = _cut_off(F.col("text"), opening, F.col("element") == F.col("first_item"))
    item = _cut_off(item, r"\}\s*$", F.col("last"))
    item = _cut_off(item, r"\]\s*$", F.col("element") == F.col("last_item"))
    return held.select("file", (F.col("element") - F.col("first_item")).alias("item"), item.alias("text")).where(
        F.regexp_replace("text", r"\s", "") != ""
    )
