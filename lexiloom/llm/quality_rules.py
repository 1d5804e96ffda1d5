"""Quality rules: a threshold table compiled into one projection.

Every measure is a Spark expression on the text of one row. ``RULES`` states
bounds on measures or ratios; ``verdict`` turns the table into one boolean
expression, so that filtering a corpus is a scan with a projection: no shuffle
and no user function.

Defined results: a null text counts as empty and has no words; texts under the
least number of words fail. Ratios over no words or no lines are 0. Rows are
judged one by one, so repeated rows get the same verdict; ids may be null; other
columns pass through; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.arrays import compute_once
from lexiloom.llm.store import empty_if_null

SPACES = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
# Frequent function words of the corpus languages (English, German, French, Spanish).
STOP_WORDS = (
    "the be to of and that have with is for on a in it was "
    "der die das und den von zu mit sich auf für des ist "
    "de la le les et des un une du que pour est qui en "
    "el los las por del se con no una y al"
).split()


@dataclass(frozen=True)
class Rule:
    """``least`` <= measure / per <= ``most``; either bound may be missing."""

    measure: str
    per: str | None = None
    least: float | None = None
    most: float | None = None


#: Production thresholds. The first two are the fixed base rules.
RULES = (
    Rule("n_words", least=50),
    Rule("n_repeat_words", "n_words", most=0.5),
    Rule("word_chars", "n_words", least=2, most=12),
    Rule("n_symbols", "n_words", most=0.1),
    Rule("n_stop_words", least=2),
    Rule("n_dup_lines", "n_lines", most=0.5),
    Rule("n_upper", "word_chars", most=0.5),
)
BASE = RULES[:2]


def words_of(text: Column) -> Column:
    """Words of a non-null text, in order."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _contains_sorted(arr: Column, x: Column) -> Column:
    """Whether a sorted array of longs holds ``x``: binary search, 2^30 entries at most."""
    steps = F.array(*[F.lit(1 << k) for k in range(29, -1, -1)])
    at = F.aggregate(
        steps,
        F.lit(0),
        lambda lo, step: F.when((lo + step <= F.size(arr)) & (F.get(arr, lo + step - 1) <= x), lo + step).otherwise(lo),
    )
    return (at > 0) & (F.get(arr, at - 1) == x)


FEW = 32  # up to this many repeated windows a scan of them beats a binary search


def _repeat_words(windows: Column, repeated: Column, n_words: Column) -> Column:
    """Number of words that some repeated 3-word window covers."""
    hit = F.when(
        F.size(repeated) <= FEW, F.transform(windows, lambda h: F.array_contains(repeated, h))
    ).otherwise(F.transform(windows, lambda h: _contains_sorted(repeated, h)))

    def covered(flags: Column) -> Column:
        return F.aggregate(
            flags,
            # words already covered, and how many of the next words are covered by windows seen so far
            F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("open")),
            lambda s, f: F.when(f, F.struct((s["n"] + 3 - s["open"]).alias("n"), F.lit(2).alias("open"))).otherwise(
                F.struct(s["n"].alias("n"), F.greatest(s["open"] - 1, F.lit(0)).alias("open"))
            ),
            lambda s: s["n"],
        )

    return F.when(F.size(repeated) > 0, covered(hit)).otherwise(F.lit(0).cast("bigint"))


def measures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and one long column for each measure of the text."""
    long = lambda c: c.cast("bigint")
    text = empty_if_null(F.col(text_col))
    kept = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)]
    names = [f"__k{i}" for i in range(len(keep))]
    a = compute_once(docs.select(*kept, text.alias("__t")), [*names, "__t"], words_of(F.col("__t")).alias("w"))
    windows = F.when(
        F.size("w") >= 3,
        F.transform(
            F.sequence(F.lit(2), F.size("w") - 1),
            lambda i: F.xxhash64(F.get("w", i - 2), F.get("w", i - 1), F.get("w", i)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("__t", "\n"), lambda s: F.length(F.translate(s, SPACES, "")) > 0)
    b = compute_once(
        a,
        [*names, "__t"],
        long(F.size("w")).alias("n_words"),
        windows.alias("h"),
        long(F.size(F.filter("w", lambda x: F.lower(x).isin(*STOP_WORDS)))).alias("n_stop_words"),
        lines.alias("l"),
    )
    bare = F.translate("__t", SPACES, "")
    c = compute_once(
        b,
        [*names, "__t", "n_words", "n_stop_words", "h", "l"],
        F.sort_array("h").alias("s"),
        long(F.length(bare)).alias("word_chars"),
    )
    repeated = F.array_distinct(F.filter("s", lambda x, i: (i > 0) & (x == F.get("s", i - 1))))
    d = compute_once(
        c, [*names, "__t", "n_words", "n_stop_words", "h", "l", "word_chars"], repeated.alias("r")
    )
    return d.select(
        *[F.col(n).alias(k) for n, k in zip(names, keep)],
        "n_words",
        "word_chars",
        long(F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).alias("n_symbols"),
        long(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        _repeat_words(F.col("h"), F.col("r"), F.col("n_words")).alias("n_repeat_words"),
        "n_stop_words",
        long(F.size("l")).alias("n_lines"),
        long(F.regexp_count("__t", F.lit(r"\p{Lu}"))).alias("n_upper"),
    )


def verdict(rules: tuple[Rule, ...]) -> Column:
    """One boolean expression: every rule of the table holds."""
    ok = F.lit(True)
    for rule in rules:
        value = F.col(rule.measure)
        if rule.per:
            value = F.when(F.col(rule.per) > 0, value / F.col(rule.per)).otherwise(F.lit(0.0))
        if rule.least is not None:
            ok = ok & (value >= rule.least)
        if rule.most is not None:
            ok = ok & (value <= rule.most)
    return ok


def judge(
    docs: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    base: tuple[Rule, ...] = BASE,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Measures with ``base_failed`` and ``kept`` for every row."""
    return measures(docs, text_col, keep).select(
        "*", (~verdict(base)).alias("base_failed"), verdict((*base, *rules)).alias("kept")
    )


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` without the rows that a rule rejects, all columns kept."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("t"))
    return judge(whole, "t", ("row",), (), rules).where("kept").select("row.*")
