"""Nearest words, smoothing of vectors on a word graph, and substitutes.

Word vectors are rows (word, vec).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.arrays import compute_once, entries
from lexiloom.functions.vectors import dot, doubles, unit
from lexiloom.operators.skew import deal, hot_keys, repeat, spread_join
from lexiloom.session import cut_lineage

ROWS_PER_BLOCK = 8192
QUERY_ROWS = 128  # rows of a block scored at once: 128 x 8192 doubles are 8 MB
PEAK_OF = 32  # similarities of which the largest is kept to bound the k-th largest
DIGITS = 12  # similarities that agree to twelve decimals count as ties


def unit_rows(vectors: pd.Series) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, size, out=np.zeros_like(m), where=size > 0)


def _floors(sims: np.ndarray, k: int) -> np.ndarray:
    """Per row a bound that its ``k`` largest entries reach, rounded or not: the k-th largest of
    the peaks of groups of entries, as each of those is an entry. No row is sorted as a whole."""
    rows, n = sims.shape
    if n < 2 * k:
        return np.full(rows, -np.inf)
    width = max(1, min(PEAK_OF, n // (2 * k)))
    peaks = np.maximum.reduceat(sims, np.arange(0, n, width), axis=1) if n % width else sims.reshape(rows, -1, width).max(axis=2)
    at = peaks.shape[1] - k
    return np.partition(peaks, at, axis=1)[:, at] - 10.0**-DIGITS


def _block_top(k: int, exclude_self: bool):
    """Best ``k`` table words per query of one pair of blocks."""

    def run(queries: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(queries) and len(table):
            # Names in order, so that a stable choice of the largest prefers the smaller name.
            table = table.sort_values("tword", kind="stable")
            names, unit_table = table["tword"].to_numpy(), unit_rows(table["tvec"])
            known = ~np.isnan(unit_table).any(axis=1)  # others are like no word
            names, unit_table = names[known], unit_table[known]
            for lo in range(0, len(queries), QUERY_ROWS):
                part = queries.iloc[lo : lo + QUERY_ROWS]
                words = part["qword"].to_numpy()
                sims = unit_rows(part["qvec"]) @ unit_table.T
                if exclude_self:
                    at = np.searchsorted(names, words)
                    mine = np.flatnonzero((at < len(names)) & (names[np.minimum(at, len(names) - 1)] == words))
                    sims[mine, at[mine]] = -np.inf
                row, col = np.nonzero((sims >= _floors(sims, k)[:, None]) & (sims > -np.inf))  # the rest is cut below
                near = np.round(sims[row, col], DIGITS)
                order = np.lexsort((col, -near, row))
                row, col, near = row[order], col[order], near[order]
                first = np.searchsorted(row, np.arange(len(words)))
                best = np.arange(len(row)) - first[row] < k
                out.append(pd.DataFrame({"word": words[row[best]], "other": names[col[best]], "sim": near[best]}))
        return pd.concat(out) if out else pd.DataFrame({"word": [], "other": [], "sim": []}, dtype="object")

    return run


def most_similar(
    queries: DataFrame,
    table: DataFrame,
    k: int = 10,
    exclude_self: bool = True,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """The ``k`` table words with the largest cosine per query word: (word, rank, other, sim).

    Exact. Both sides are cut into hash blocks of about ``rows_per_block`` rows
    and every pair of blocks is one task: a matrix product that returns at most
    ``k`` rows per query, merged afterwards. A task holds two blocks whatever
    the sizes of the tables. ``word`` identifies a row on either side.
    """
    sizes = [max(1, -(-side.count() // rows_per_block)) for side in (queries, table)]

    def block(side: DataFrame, name: str, n_mine: int, n_other: int) -> DataFrame:
        """Rows with the hash block they belong to and a copy per block of the other side."""
        return side.select(
            F.col("word").alias(f"{name}word"),
            F.col("vec").alias(f"{name}vec"),  # as it is: the copies of floats stay floats
            F.pmod(F.xxhash64("word"), F.lit(n_mine)).cast("int").alias(f"{name}mine"),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(f"{name}other"),
        )

    q = block(queries, "q", sizes[0], sizes[1])
    t = block(table, "t", sizes[1], sizes[0])
    kind = table.schema["word"].dataType.simpleString()
    blocks = (
        q.groupBy("qmine", "qother")
        .cogroup(t.groupBy("tother", "tmine"))
        .applyInPandas(_block_top(k, exclude_self), f"word {kind}, other {kind}, sim double")
    )
    order = Window.partitionBy("word").orderBy(F.desc("sim"), "other")
    return blocks.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def similar_in_buckets(
    queries: DataFrame,
    table: DataFrame,
    dim: int,
    k: int = 10,
    tables: int = 32,
    bits: int = 5,
    seed: int = 0,
    exclude_self: bool = True,
) -> DataFrame:
    """Like ``most_similar``, but only words that share a bucket are compared:
    (word, rank, other, sim). Approximate in which words it finds, exact in their
    similarities and order. Query words that meet fewer than ``k`` others are
    searched by ``most_similar``, so no word gets fewer rows than there.

    A bucket is the side of ``bits`` random hyperplanes on which a vector of
    ``dim`` numbers lies, in each of ``tables`` independent tables. Words at an
    angle a share one with probability 1 - (1 - (1 - a / pi) ** bits) ** tables.
    More bits make buckets smaller, more tables find more. The defaults find nine
    in ten of the nearest words even where these are far (a cosine of 0.35), at
    the price of comparing most pairs of words; for near ones (0.8) 16 tables of
    8 bits do as well and compare a tenth of the pairs. Every word is indexed and
    nothing is capped: hot buckets are dealt over many tasks.
    """
    planes = np.random.default_rng(seed).normal(size=(tables, bits, dim))

    def bucketed(side: DataFrame, name: str) -> DataFrame:
        u = F.col(f"{name}u")
        code = lambda t: sum(
            (F.when(dot(u, F.array(*[F.lit(float(x)) for x in planes[t, b]])) >= 0, 1 << b).otherwise(0) for b in range(bits)),
            F.lit(0),
        )
        codes = F.array(*[F.struct(F.lit(t).alias("t"), code(t).alias("b")) for t in range(tables)])
        units = compute_once(side, ["word"], unit(F.col("vec")).alias(f"{name}u"))
        return units.select(F.col("word").alias(f"{name}word"), f"{name}u", F.inline(codes))

    q, t = bucketed(queries, "q"), bucketed(table, "t")
    met = spread_join(t, q, ["t", "b"], "inner", ["tword"])
    met = met.where(F.col("qword") != F.col("tword")) if exclude_self else met
    # The same two words may meet in several tables; their similarity is the same there.
    pairs = met.select(
        F.col("qword").alias("word"), F.col("tword").alias("other"), F.round(dot(F.col("qu"), F.col("tu")), DIGITS).alias("sim")
    )
    best = pairs.groupBy("word", "other").agg(F.max("sim").alias("sim"))
    order = Window.partitionBy("word").orderBy(F.desc("sim"), "other")
    found = cut_lineage(best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    full = found.where(F.col("rank") == k).select("word")
    rest = cut_lineage(queries.join(full, "word", "left_anti"))
    return found.join(full, "word", "left_semi").unionByName(most_similar(rest, table, k, exclude_self))


def vector_size(vectors: DataFrame, vec: str = "vec") -> int:
    """Number of dimensions, read from one row."""
    row = vectors.select(F.size(vec).alias("n")).first()
    return row["n"] if row else 0


def _sum_columns(vec: str, dim: int) -> list[Column]:
    """Plain sums, one per dimension: fixed-width buffers that combine on the map side."""
    return [F.sum(F.get(vec, i)).alias(f"__d{i}") for i in range(dim)]


def _sum_array(dim: int) -> Column:
    return F.array(*[f"__d{i}" for i in range(dim)])


def retrofit(
    vectors: DataFrame,
    edges: DataFrame,
    iters: int = 10,
    alpha: float = 1.0,
    beta: float = 2.19,
    published: bool = False,
    cut_every: int = 3,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Pull the vectors of neighbouring words together.

    In every round a word with neighbours becomes ``(alpha * original + beta *
    sum of neighbours) / (n * (alpha + beta))``; ``published`` divides by
    ``alpha + n * beta``. All words of a round read the round before. Words
    without a neighbour in the table keep their vector. ``edges`` is (head,
    neighbour); repeated edges count once.
    """
    words = vectors.select("word")
    graph = cut_lineage(
        edges.select("head", "neighbour")
        .distinct()
        .join(words.withColumnRenamed("word", "head"), "head", "left_semi")
        .join(words.withColumnRenamed("word", "neighbour"), "neighbour", "left_semi")
    )
    degree = graph.groupBy(F.col("head").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    original = cut_lineage(
        vectors.select("word", doubles(F.col("vec")).alias("vec")).join(degree, "word", "left")
    )
    dim = vector_size(original)
    divisor = (alpha + F.col("n") * beta) if published else F.col("n") * (alpha + beta)
    # A round is one sum per word: its own row, weighted, and one weighted row per neighbour.
    share = F.coalesce(alpha / divisor, F.lit(1.0))
    own = cut_lineage(original.select("word", F.transform("vec", lambda x: x * share).alias("vec")))
    weighted = graph.join(degree.withColumnRenamed("word", "head"), "head").select("neighbour", "head", (beta / divisor).alias("w"))
    hot = cut_lineage(hot_keys(graph, ["neighbour"], rows_per_task))
    keys = ["neighbour"]
    if not hot.isEmpty():
        keys = ["neighbour", "__part"]
        weighted = deal(weighted, hot, ["neighbour"], ["head"])
    # Links stay laid out by the neighbour, and the sums of a round by the word: the only
    # exchange of a round is that of the sums.
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = cut_lineage(weighted.repartition(parts, *keys))
    current = original.select("word", "vec")
    for i in range(1, iters + 1):
        sources = current.withColumnRenamed("word", "neighbour")
        if len(keys) > 1:
            sources = repeat(sources, hot, ["neighbour"])
        w = F.col("w")
        sent = links.join(sources, keys).select(F.col("head").alias("word"), F.transform("vec", lambda x: x * w).alias("vec"))
        current = sent.unionByName(own).groupBy("word").agg(*_sum_columns("vec", dim)).select("word", _sum_array(dim).alias("vec"))
        if i % cut_every == 0 and i < iters:
            current = cut_lineage(current)
    return current


def rerank_in_context(
    cands: DataFrame,
    queries: DataFrame,
    vectors: DataFrame,
    topn: int = 10,
    ascending: bool = False,
) -> DataFrame:
    """Order candidates by their fit to the target and to the sentence around it:
    (qid, rank, other, score).

    ``queries`` is (qid, target_idx, tokens), ``cands`` (qid, other). The score
    averages the cosine to the target and the mean cosine to the ``n`` distinct
    known context words. Since a sum of cosines is a product with the sum of
    unit vectors, each sentence is first summed up into one vector; candidates
    are never paired with context words. A sentence without known context
    words gives no rows.
    """
    # Read three times: to find the words of most rows, to count an even share, and to be scored.
    # A search that the candidates come from is run once.
    cands = cut_lineage(cands.select("qid", "other"))
    units = vectors.select("word", unit(F.col("vec")).alias("u"))
    dim = vector_size(vectors)
    context = (
        queries.select("qid", "target_idx", F.posexplode(entries(F.col("tokens"))).alias("pos", "word"))
        .where(F.col("pos") != F.col("target_idx"))
        .select("qid", "word")
        .distinct()
    )
    summed = (
        spread_join(context, units, ["word"], "inner", ["qid"])
        .groupBy("qid")
        .agg(F.count(F.lit(1)).alias("n"), *_sum_columns("u", dim))
        .select("qid", "n", _sum_array(dim).alias("around"))
    )
    target = queries.select("qid", F.get("tokens", F.col("target_idx")).alias("word"))
    focus = spread_join(target, units, ["word"], "inner", ["qid"]).select("qid", F.col("u").alias("t"))
    sentence = summed.join(focus, "qid").select(
        "qid",
        F.zip_with("t", "around", lambda t, c: (t * F.col("n") + c) / (2 * F.col("n"))).alias("s"),
    )
    others = units.select(F.col("word").alias("other"), F.col("u").alias("c"))
    scored = spread_join(cands, others, ["other"], "inner", ["qid"]).join(sentence, "qid").select(
        "qid", "other", F.round(dot(F.col("c"), F.col("s")), DIGITS).alias("score")
    )
    best = F.asc("score") if ascending else F.desc("score")
    order = Window.partitionBy("qid").orderBy(best, "other")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= topn)


def substitutes(
    queries: DataFrame, vectors: DataFrame, k: int = 10, context: bool = False, topn: int | None = None
) -> DataFrame:
    """The guesses for the word at ``target_idx`` of each sentence: (qid, guesses).

    Each distinct target word is searched once. A target that has no vector
    gets an empty list.
    """
    targets = queries.select("qid", F.get("tokens", F.col("target_idx")).alias("word"))
    wanted = vectors.join(targets.select("word").distinct(), "word", "left_semi")
    found = most_similar(wanted, vectors, k)
    lists = found.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("rank", "other"))).alias("__g"))
    per_query = spread_join(targets, lists, ["word"], "left", ["qid"]).select("qid", "__g")
    if context:
        cands = per_query.select("qid", F.explode(entries(F.col("__g"))).alias("g")).select("qid", "g.other")
        ranked = rerank_in_context(cands, queries, vectors, topn or k)
        lists = ranked.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "other"))).alias("__g"))
        per_query = queries.select("qid").join(lists, "qid", "left")
    kind = vectors.schema["word"].dataType.simpleString()
    return per_query.select(
        "qid",
        F.coalesce(F.transform("__g", lambda g: g["other"]), F.array().cast(f"array<{kind}>")).alias("guesses"),
    )


def hit_precision(gold: DataFrame, pred: DataFrame, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with one of the first ``k`` guesses in the gold set: (n, precision)."""
    keys = [*by, "qid"]
    joined = gold.select(*keys, "gold").join(pred.select(*keys, "guesses"), keys)
    hit = F.coalesce(F.arrays_overlap(F.slice("guesses", 1, k), F.col("gold")), F.lit(False)).cast("double")
    return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("precision"))
