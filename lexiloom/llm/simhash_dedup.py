"""SimHash near-duplicates by an inverted index on byte positions.

A fingerprint of 64 bits is eight bytes. Two fingerprints that differ in at most
four bits agree in at least four of the eight positions: the guaranteed minimum
of matches. A posting list of a single (position, byte) would hold 1/256 of the
corpus, and counting matches over such lists emits nearly all pairs. So the
index is kept at the level that counting would have to reach: a posting is the
joint value of four positions, and a pair that shares m bytes meets in C(m, 4)
of the 70 postings. Meeting in one is having the minimum, so no pair below it is
ever made and no count is left to filter by; pairs are verified by counting bits.

Only distinct fingerprints are indexed, so copies never meet each other. Members
of a posting are linked by a spanning forest of its verified links, not by all
pairs: components stay the same. A posting with more than ``DENSE`` members is
not compared pair by pair: two fingerprints are within four bits exactly if some
value is within two bits of both. Each member of any such posting is sent, once,
to the 2,081 values within two bits and linked to the smallest member there, which
is linear in the members and spread over all tasks.

Defined results: null counts as empty; a text without words has fingerprint 0; a
text of one to three words has its whole word sequence as the only shingle. Null
ids take part but are never the smallest id if there is another. Very long texts
are hashed a stretch of shingles at a time. Repeated rows fall into one component.
``near_duplicates`` returns its own columns only, ``drop_near_duplicates`` all
columns of the rows it keeps. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexiloom.llm import exact_dedup
from lexiloom.llm.graph import components
from lexiloom.llm.store import empty_if_null, map_arrow, partitions, slices, stored
from lexiloom.operators.skew import spread_join

SEED = 42
MAX_BITS = 4
MIN_BYTES = 8 - MAX_BITS
DENSE = 512
SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: str, k: int = 4) -> int:
    """64-bit fingerprint of the ``k``-word shingles, as an unsigned number."""
    words = text.encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(k, len(words)) - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLES_AT_ONCE):
        span = zip(starts[at : at + SHINGLES_AT_ONCE], stops[at : at + SHINGLES_AT_ONCE])
        h = np.array([digest(joined[a:b], SEED) for a, b in span], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4) -> DataFrame:
    """(id, fp) of every row; fp holds the 64 bits as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), empty_if_null(F.col(text_col)).alias("text"))
    kind = rows.schema["id"].dataType
    arrow = to_arrow_type(kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = np.array([fingerprint(t, k) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(arrow), pa.array(fps)], ["id", "fp"])

    return map_arrow(rows, scan, f"id {kind.simpleString()}, fp long")


def masks() -> list[int]:
    """The masks of all choices of ``MIN_BYTES`` byte positions, as signed longs."""
    out = []
    for chosen in combinations(range(8), MIN_BYTES):
        m = sum(0xFF << (8 * p) for p in chosen)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def _roots(fps: np.ndarray) -> np.ndarray:
    """Smallest position linked to each member of one posting, by verified links."""
    x = fps.view(np.uint64)
    diff = x[:, None] ^ x[None, :]
    linked = np.bitwise_count(diff) <= MAX_BITS
    root = np.arange(len(x))
    while True:  # the smallest label among the neighbours, until nothing changes
        now = np.where(linked, root[None, :], len(x)).min(axis=1)
        now = now[now]
        if (now == root).all():
            return root
        root = now


def posting_links(postings: Iterator[pa.RecordBatch], dense: int = DENSE) -> Iterator[pa.RecordBatch]:
    """Links (u, v, hot) of the postings in batches sorted by (mask, key).

    hot = true marks the member ``u`` of a posting of more than ``dense`` members (``v`` is
    its mask), for the linear path. At most ``dense`` members of an
    open posting are held back between batches.
    """

    def emit(u, v, hot):
        u = np.asarray(u, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(np.asarray(v, np.int64)), pa.array(np.full(len(u), hot))], ["u", "v", "hot"])

    def close(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        two = starts[sizes == 2]
        a, b = fps[two], fps[two + 1]
        diff = (a ^ b).view(np.uint64)
        near = np.bitwise_count(diff) <= MAX_BITS
        yield emit(a[near], b[near], False)
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            own = fps[s : s + n]
            root = _roots(own)
            other = root != np.arange(n)
            if other.any():
                yield emit(own[other], own[root[other]], False)

    held: np.ndarray | None = None  # members of the posting that is still open
    name: tuple[int, int] | None = None
    hot = False
    for batch in postings:
        mask, key, fp = (batch.column(c).to_numpy() for c in ("mask", "key", "fp"))
        if not len(fp):
            continue
        new = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        bounds = np.concatenate(([0], new, [len(fp)]))
        starts, sizes = bounds[:-1], np.diff(bounds)
        if name == (mask[0], key[0]):  # the open posting goes on
            first = fp[: sizes[0]]
        else:
            first = None
            if held is not None and not hot and len(held) > 1:
                yield from close(held, np.array([0]), np.array([len(held)]))
            held, hot = None, False
        if first is not None:
            held = np.concatenate((held, first)) if not hot else held
            if hot:
                yield emit(first, np.full(len(first), name[0]), True)
            elif len(held) > dense:
                yield emit(held, np.full(len(held), name[0]), True)
                held, hot = held[:0], True
            starts, sizes = starts[1:], sizes[1:]
            if not len(starts):
                continue
            if not hot and len(held) > 1:
                yield from close(held, np.array([0]), np.array([len(held)]))
            held, hot = None, False
        big = sizes[:-1] > dense
        for s, n in zip(starts[:-1][big].tolist(), sizes[:-1][big].tolist()):
            yield emit(fp[s : s + n], np.full(n, mask[s]), True)
        inner = ~big & (sizes[:-1] > 1)
        yield from close(fp, starts[:-1][inner], sizes[:-1][inner])
        last = starts[-1]
        name, held = (mask[last], key[last]), fp[last:]
        if len(held) > dense:
            yield emit(held, np.full(len(held), name[0]), True)
            held, hot = held[:0], True
    if held is not None and not hot and len(held) > 1:
        yield from close(held, np.array([0]), np.array([len(held)]))


def _midpoint_links(hot: DataFrame) -> DataFrame:
    """Links between the members (u) of crowded postings: members within two bits of the same value.

    A member meets 2,081 values, however many of its postings are crowded: itself, and it
    with one or two of 64 bits flipped. Two members four bits apart share a value halfway.
    """
    bits = F.array(*[F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i) for i in range(64)])
    flips = F.concat(
        F.array(F.lit(0).cast("bigint")),
        F.col("bits"),
        F.flatten(F.transform("bits", lambda b, i: F.transform(F.slice(F.col("bits"), i + 2, F.size("bits")), lambda c: b.bitwiseXOR(c)))),
    )
    members = hot.select("u").distinct().select("u", bits.alias("bits"))
    near = members.select("u", F.explode(flips).alias("flip")).select("u", F.col("u").bitwiseXOR(F.col("flip")).alias("mid"))
    least = near.groupBy("mid").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return near.join(least, "mid").where("u <> m").select("u", F.col("m").alias("v")).distinct()


def links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fps`` (fp) that leave the
    components of "at most four bits apart" as they are."""
    indexed = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in masks()])).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
    )
    n = partitions(fps)
    dealt = indexed.repartition(n, "mask", "key").sortWithinPartitions("mask", "key")
    found = stored(map_arrow(dealt, lambda it: posting_links(it, dense), "u long, v long, hot boolean"))
    return found.where("NOT hot").select("u", "v").unionByName(_midpoint_links(found.where("hot").select("u")))


def _classes(rows: DataFrame, dense: int) -> DataFrame:
    """(fp, component_id, root) of every fingerprint of ``rows`` (id, fp)."""
    groups = stored(rows.groupBy("fp").agg(F.min("id").alias("least")))
    root = components(links(groups.select("fp"), dense)).select(F.col("node").alias("fp"), "root")
    named = stored(groups.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # A component may hold a third of all fingerprints: its rows are dealt.
    return stored(spread_join(named, smallest, ["root"], "inner", ["fp"]).select("fp", "component_id", "root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, dense: int = DENSE
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id."""
    rows = stored(fingerprints(docs, id_col, text_col, k))
    labels = _classes(rows, dense).drop("root")
    return spread_join(rows, labels, ["fp"], "inner", ["id"]).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, dense: int = DENSE
) -> DataFrame:
    """``docs`` with one whole row of every component: that of the smallest id.

    Rows that agree in id and text are one. A component without any id keeps the
    row of its smallest text digest.
    """
    rows = stored(fingerprints(docs, id_col, text_col, k))
    labels = _classes(rows, dense)
    stay = labels.where("component_id IS NOT NULL").select(F.col("component_id").alias("__id")).distinct()
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("__id"),
        exact_dedup.digest(F.col(text_col)).alias("__d"),
        empty_if_null(F.col(text_col)).alias("__t"),
    )
    named = whole.where("__id IS NOT NULL").drop("__t").join(stay, "__id", "left_semi").dropDuplicates(["__id", "__d"])
    # Rows without an id, if there are any: one of each text, then one of each component that has no id at all.
    nameless = stored(whole.where("__id IS NULL").dropDuplicates(["__d"]))
    prints = fingerprints(nameless, "__d", "__t", k).select(F.col("id").alias("__d"), "fp")
    best = (
        prints.join(labels.where("component_id IS NULL"), "fp").groupBy("root").agg(F.min("__d").alias("__d")).select("__d")
    )
    return named.select("row.*").unionByName(nameless.join(best, "__d", "left_semi").select("row.*"))
