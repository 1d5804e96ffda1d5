"""Array helpers built from higher-order functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 64


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def compute_once(df: DataFrame, keep: Sequence[str], *cols: Column) -> DataFrame:
    """Select ``keep`` and the named ``cols`` so that later steps read their values.

    Plain projections are merged by the optimizer, which repeats a costly
    expression wherever its result is used; a generator is not merged.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*cols))))


def entries(arr: Column) -> Column:
    """An array column to be exploded.

    For a bare column the optimizer adds a filter on its size and moves it down
    to where the array is computed, which computes it again. A concatenation of
    one array has the same entries and gets no such filter.
    """
    return F.concat(arr)


def running_sum(values: Column, kind: str = "int") -> Column:
    """Inclusive prefix sums of a numeric array, inside the row.

    Cut into chunks of 64 so that the appended arrays stay short: the work
    grows with the length of the array, not with its square.
    """
    return bind(values, lambda arr: _running_sum(arr, kind))


def _running_sum(arr: Column, kind: str) -> Column:
    zero = F.lit(0).cast(kind)
    empty = F.array().cast(f"array<{kind}>")
    last = F.floor((F.size(arr) - 1) / CHUNK).cast("int")
    numbers = F.when(F.size(arr) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def scan(values: Column, first: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(first.alias("t"), empty.alias("a")),
            lambda acc, x: F.struct(
                (acc["t"] + x).alias("t"), F.concat(acc["a"], F.array(acc["t"] + x)).alias("a")
            ),
            lambda acc: acc["a"],
        )

    def chunk(j: Column) -> Column:
        return F.slice(arr, j * CHUNK + 1, F.lit(CHUNK))

    sums = F.transform(numbers, lambda j: F.aggregate(chunk(j), zero, lambda t, x: t + x))
    return bind(
        sums,
        lambda s: F.flatten(
            F.transform(
                F.arrays_zip(numbers.alias("j"), scan(s, zero).alias("e"), s.alias("s")),
                lambda z: scan(chunk(z["j"]), z["e"] - z["s"]),
            )
        ),
    )


SHORT = 256  # up to this size a linear search per entry beats counting runs
MARK = "\u0001"


def numbered(arr: Column) -> Column:
    """Sort a string array and tag each value with its occurrence number, so that
    a set operation on the result is a bag operation on the input."""
    tag = lambda x, k: F.concat_ws(MARK, x, k.cast("string"))

    def by_search(s: Column) -> Column:
        return F.transform(s, lambda x, i: tag(x, i + 1 - F.array_position(s, x)))

    def by_runs(s: Column) -> Column:
        opens = F.transform(
            s, lambda x, i: F.when((i == 0) | (x != F.element_at(s, F.greatest(i, F.lit(1)))), 1).otherwise(0)
        )

        def place(v: Column) -> Column:
            firsts = F.filter(F.transform(v["o"], lambda o, i: F.when(o == 1, i)), lambda i: i.isNotNull())
            return bind(
                F.struct(firsts.alias("f"), running_sum(v["o"]).alias("r")),
                lambda w: F.transform(s, lambda x, i: tag(x, i - F.element_at(w["f"], F.element_at(w["r"], i + 1)))),
            )

        return bind(F.struct(opens.alias("o")), place)

    return bind(F.array_sort(arr), lambda s: F.when(F.size(s) <= SHORT, by_search(s)).otherwise(by_runs(s)))


def bag_overlap(a: Column, b: Column) -> Column:
    """Size of the bag intersection of two string arrays."""
    return F.size(F.array_intersect(numbered(a), numbered(b)))


def top_indexes(arr: Column, n: int) -> Column:
    """Indexes (0-based) and values of the ``n`` largest entries; lower index first on ties."""
    pairs = F.transform(arr, lambda x, i: F.struct((-x).alias("neg"), i.alias("idx")))
    best = F.slice(F.array_sort(pairs), 1, n)
    return F.transform(best, lambda p: F.struct(p["idx"].alias("idx"), (-p["neg"]).alias("val")))
