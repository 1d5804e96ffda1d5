"""URL filters over time: dated list entries as validity intervals, joined as of the fetch.

A list is a log of dated entries: on a day a host, a domain or a URL prefix is
added under a category or removed again. Per (rule, category) the log becomes
disjoint intervals [added, removed). All intervals of a rule are kept as one row,
so a capture meets a rule at most once and looks up the state at its fetch time
inside the row.

A capture is looked up by its host, the host's parent domains and its URL without
query, cut at every path segment: one key per label and segment. Captures are first
reduced to distinct (url, day) pairs; their keys meet the rules in a join that deals
hot keys over many tasks, because one host may hold a third of all captures.
Verdicts return to the captures by (url, day), which no host makes hot.

Defined results: a null or malformed URL matches nothing and is kept; a capture
without a fetch time is judged as not listed. An entry takes effect at the start
of its day; of entries for the same rule and day a removal wins. Repeated
captures are separate rows. Extra columns pass through; ``listed`` and ``kept``
are replaced if the captures have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.store import stored
from lexiloom.operators.skew import spread_join


def host_of(url: Column) -> Column:
    """Lower-case host of an http(s) URL without port or user, or null."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    host = F.lower(F.rtrim(authority, F.lit(".")))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)?", 1)


def capture_keys(url: Column) -> Column:
    """The keys a rule may name: ``d:`` and the host or a parent domain, ``u:`` and
    the host with leading path segments."""
    labels = F.split(host_of(url), r"\.")
    n = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), n),
        lambda k: F.concat(F.lit("d:"), F.array_join(F.slice(labels, n - k + 1, k), ".")),
    )
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    prefixes = F.transform(
        segments, lambda s, i: F.concat(F.lit("u:"), host_of(url), F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i + 1), "/"))
    )
    return F.when(host_of(url).isNull(), F.array().cast("array<string>")).otherwise(F.concat(domains, prefixes))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (rule, category, since, until) of a log (rule, category, day, added).

    ``until`` is null while an entry is in force.
    """
    daily = entries.where(F.col("day").isNotNull() & F.col("rule").isNotNull() & F.col("added").isNotNull()).groupBy("rule", "category", "day").agg(F.min("added").alias("added"))
    log = Window.partitionBy("rule", "category").orderBy("day")
    changes = daily.withColumn("was", F.lag("added").over(log)).where(F.col("was").isNull() & F.col("added") | (F.col("was") != F.col("added")))
    return changes.withColumn("until", F.lead("day").over(log)).where("added").select("rule", "category", F.col("day").alias("since"), "until")


def in_force(intervals: Column, day: Column) -> Column:
    """Categories whose interval holds ``day``, as of that day."""
    return F.transform(
        F.filter(intervals, lambda v: (v["since"] <= day) & (v["until"].isNull() | (day < v["until"]))), lambda v: v["category"]
    )


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "day") -> DataFrame:
    """``captures`` with ``listed`` (sorted categories in force at the fetch) and ``kept``."""
    rules = stored(
        validity(entries)
        .groupBy("rule")
        .agg(F.array_sort(F.collect_list(F.struct("since", "until", "category"))).alias("intervals"))
    )
    seen = stored(
        captures.select(F.col(url_col).cast("string").alias("url"), F.col(day_col).cast("date").alias("day"))
        .where("url IS NOT NULL AND day IS NOT NULL")
        .distinct()
    )
    keyed = seen.select("url", "day", F.explode(capture_keys(F.col("url"))).alias("rule"))
    hits = spread_join(keyed, rules, ["rule"], "inner", ["url", "day"]).select(
        "url", "day", F.explode(in_force(F.col("intervals"), F.col("day"))).alias("category")
    )
    verdicts = stored(hits.groupBy("url", "day").agg(F.array_sort(F.collect_set("category")).alias("listed")))
    whole = captures.select(
        F.struct(*[F.col(f"`{c}`") for c in captures.columns if c.lower() not in ("listed", "kept")]).alias("row"),
        F.col(url_col).cast("string").alias("__u"),
        F.col(day_col).cast("date").alias("__d"),
    )
    # A URL may be fetched very often in a day: its captures are dealt by their number. Captures
    # without a URL or a day have no verdict and go around the join.
    numbered = whole.withColumn("__n", F.monotonically_increasing_id())
    fetched = F.col("__u").isNotNull() & F.col("__d").isNotNull()
    named = verdicts.select(F.col("url").alias("__u"), F.col("day").alias("__d"), "listed")
    joined = spread_join(numbered.where(fetched), named, ["__u", "__d"], "left", ["__n"]).select("row", "listed")
    joined = joined.unionByName(whole.where(~fetched).select("row", F.lit(None).cast("array<string>").alias("listed")))
    listed = F.coalesce("listed", F.array().cast("array<string>"))
    return joined.select("row", listed.alias("listed")).select("row.*", "listed", (F.size("listed") == 0).alias("kept"))
