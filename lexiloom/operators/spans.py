"""From per-token scores to n-best answer spans.

A window is one row; its best starts and ends are paired inside the row, which
gives at most n * n candidates. Questions are grouped only after that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.arrays import bind, compute_once, top_indexes
from lexiloom.functions.text import join_wordpieces, project_to_source_text
from lexiloom.operators.skew import hot_keys, spread_join

DIGITS = 9  # scores that agree to nine decimals count as ties


def top_logits(df: DataFrame, logits: str, n: int = 20) -> DataFrame:
    """The ``n`` best entries of an array per row: adds (rank, idx, val), rank from 1."""
    best = top_indexes(F.col(logits), n)
    return df.select(*[c for c in df.columns if c != logits], F.posexplode(best).alias("rank", "b")).select(
        "*", (F.col("rank") + 1).alias("__r"), "b.idx", "b.val"
    ).drop("rank", "b").withColumnRenamed("__r", "rank")


def span_candidates(results: DataFrame | None, features: DataFrame, n: int = 20, max_answer: int = 30) -> DataFrame:
    """All pairs of a window's best starts and ends that form a valid answer.

    ``results`` is (unique_id, start_logits, end_logits), ``features`` (unique_id,
    qid, feature_index, tokens, token_to_orig, is_max_context, ...). Where the rows of
    ``features`` already carry both logits, ``results`` is None and nothing is shuffled. Valid: both
    ends in the passage, the start in its best window, end not before start, at
    most ``max_answer`` tokens. ``start_rank`` and ``end_rank`` keep the order
    in which pairs are formed.
    """
    logits = ["start_logits", "end_logits"]
    joined = features if results is None else features.join(results.select("unique_id", *logits), "unique_id")
    orig, context = F.col("token_to_orig"), F.col("is_max_context")

    def usable(best: Column, start: bool) -> Column:
        ranked = F.transform(
            best, lambda b, r: F.struct(b["idx"].alias("idx"), b["val"].cast("double").alias("val"), r.alias("rank"))
        )
        in_passage = lambda b: F.get(orig, b["idx"]).isNotNull() & (b["idx"] < F.size("tokens"))
        if not start:
            return F.filter(ranked, in_passage)
        return F.filter(ranked, lambda b: in_passage(b) & F.coalesce(F.get(context, b["idx"]), F.lit(False)))

    ends = usable(top_indexes(F.col("end_logits"), n), False)
    starts = usable(top_indexes(F.col("start_logits"), n), True)

    def pair(s: Column, e: Column) -> Column:
        return F.struct(
            s["idx"].alias("start"),
            e["idx"].alias("end"),
            s["val"].alias("start_logit"),
            e["val"].alias("end_logit"),
            s["rank"].alias("start_rank"),
            e["rank"].alias("end_rank"),
        )

    pairs = bind(
        F.struct(starts.alias("s"), ends.alias("e")),
        lambda v: F.flatten(
            F.transform(
                v["s"],
                lambda s: F.transform(
                    F.filter(v["e"], lambda e: (e["idx"] >= s["idx"]) & (e["idx"] - s["idx"] < max_answer)),
                    lambda e: pair(s, e),
                ),
            )
        ),
    )
    return joined.select(*[c for c in features.columns if c not in logits], F.inline(pairs))


def span_text(cands: DataFrame, lower: bool = True) -> DataFrame:
    """Add ``text``: the source text of each candidate.

    Needs (tokens, token_to_orig, orig_tokens, orig_first) of the window. A
    candidate at index 0 stands for no answer and has an empty text.
    """
    pick = lambda arr, a, b: F.slice(arr, a + 1, b - a + 1)
    first = F.get("token_to_orig", F.col("start")) - F.col("orig_first")
    last = F.get("token_to_orig", F.col("end")) - F.col("orig_first")
    kept = [c for c in cands.columns if c not in ("tokens", "token_to_orig", "orig_tokens", "orig_first", "is_max_context")]
    sides = compute_once(
        cands,
        kept,
        join_wordpieces(pick("tokens", F.col("start"), F.col("end"))).alias("__tok"),
        F.array_join(pick("orig_tokens", first, last), " ").alias("__orig"),
    )
    text = F.when(F.col("start") > 0, project_to_source_text(F.col("__tok"), F.col("__orig"), lower)).otherwise("")
    return sides.withColumn("text", text).drop("__tok", "__orig")


def located_spans(cands: DataFrame) -> DataFrame:
    """Candidates without their window: adds ``tok`` (the window's text of the span) and
    ``orig_start`` and ``orig_end``, its tokens in the source text."""
    kept = [c for c in cands.columns if c not in ("tokens", "token_to_orig", "is_max_context")]
    size = F.col("end") - F.col("start") + 1
    return cands.select(
        *kept,
        join_wordpieces(F.slice("tokens", F.col("start") + 1, size)).alias("tok"),
        F.get("token_to_orig", F.col("start")).alias("orig_start"),
        F.get("token_to_orig", F.col("end")).alias("orig_end"),
    )


def decode_spans(cands: DataFrame, sources: DataFrame, lower: bool = True, hot: DataFrame | None = None) -> DataFrame:
    """One candidate per different text of a question, decoded: the columns that
    ``nbest_spans`` takes, with ``text``.

    ``cands`` comes from ``located_spans``, ``sources`` is (qid, orig_tokens). Windows
    overlap, so the best candidate of every source range is taken first, by an aggregate
    with map-side combining; only these meet the source text, by question, and are
    decoded. A question with very many candidates is dealt over several tasks; ``hot``
    names these (qid, __fan) where the caller knows them. If it knows that there are
    none, candidates and sources that both lie by question meet without a shuffle.
    """
    score = F.round(F.col("start_logit") + F.col("end_logit"), DIGITS)
    held = F.struct((-score).alias("neg"), *ORDER, "start", "end", "start_logit", "end_logit")
    ranges = cands.groupBy("qid", "orig_start", "orig_end", "tok").agg(F.min(held).alias("b"))
    source = sources.select("qid", "orig_tokens")
    if hot is not None and hot.isEmpty():
        met = ranges.join(source, "qid")
    else:
        met = spread_join(ranges, source, ["qid"], "inner", ["orig_start", "orig_end"], hot=hot)
    orig = F.array_join(F.slice("orig_tokens", F.col("orig_start") + 1, F.col("orig_end") - F.col("orig_start") + 1), " ")
    sides = compute_once(met, ["qid", "tok", "b"], orig.alias("__orig"))
    decoded = sides.select("qid", "b", project_to_source_text(F.col("tok"), F.col("__orig"), lower).alias("text"))
    best = decoded.groupBy("qid", "text").agg(F.min("b").alias("b"))
    return best.select("qid", "text", *[f"b.{c}" for c in (*ORDER, "start", "end", "start_logit", "end_logit")])


def null_scores(results: DataFrame, features: DataFrame) -> DataFrame:
    """Per question the smallest no-answer score (first position of both arrays)
    and its parts: (qid, score_null, start_logit, end_logit). The first window wins ties."""
    s = F.get("start_logits", 0).cast("double")
    e = F.get("end_logits", 0).cast("double")
    joined = features.select("unique_id", "qid", "feature_index").join(results, "unique_id")
    best = joined.groupBy("qid").agg(
        F.min(F.struct((s + e).alias("score"), "feature_index", s.alias("s"), e.alias("e"))).alias("b")
    )
    return best.select(
        "qid",
        F.least(F.col("b.score"), F.lit(1e6)).alias("score_null"),
        F.col("b.s").alias("start_logit"),
        F.col("b.e").alias("end_logit"),
    )


ORDER = ("feature_index", "start_rank", "end_rank")


def _rank(df: DataFrame, name: str = "rank") -> DataFrame:
    by = Window.partitionBy("qid").orderBy(F.desc("score"), *ORDER)
    return df.withColumn(name, F.row_number().over(by))


def _distinct_texts(cands: DataFrame, n: int) -> DataFrame:
    """The best candidate of each text, then the ``n`` best texts per question.

    The first step combines on the map side; the rank limit is applied before
    and after the shuffle, so no task sorts a whole question.
    """
    score = F.round(F.col("start_logit") + F.col("end_logit"), DIGITS)
    best = cands.groupBy("qid", "text").agg(
        F.min(F.struct((-score).alias("neg"), *ORDER, "start_logit", "end_logit")).alias("b")
    )
    flat = best.select("qid", "text", (-F.col("b.neg")).alias("score"), *[f"b.{c}" for c in (*ORDER, "start_logit", "end_logit")])
    return _rank(flat).where(F.col("rank") <= n)


def nbest_spans(
    cands: DataFrame,
    n: int = 20,
    questions: DataFrame | None = None,
    nulls: DataFrame | None = None,
    fallback: tuple[str, float] = ("empty", 0.0),
) -> DataFrame:
    """The ``n`` best distinct answers per question: (qid, rank, text,
    start_logit, end_logit, probability).

    ``questions`` (qid) lists all questions; those without a candidate get the
    ``fallback`` text and score. With ``nulls`` (see ``null_scores``) the empty
    answer competes too and is always in the list; a list of the empty answer
    alone is preceded by ``empty``.
    """
    top = _distinct_texts(cands, n)
    text, value = fallback
    if nulls is not None:
        big = F.lit(2**31 - 1)
        empty = nulls.select(
            "qid",
            F.lit("").alias("text"),
            F.round(F.col("start_logit") + F.col("end_logit"), DIGITS).alias("score"),
            *[big.alias(c) for c in ORDER],
            "start_logit",
            "end_logit",
        )
        # n + 1 rows per question at most from here on.
        merged = _rank(top.drop("rank").where(F.col("text") != "").unionByName(empty))
        top = merged.where((F.col("rank") <= n) | (F.col("text") == ""))
        sized = top.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("qid")))
        alone = F.when(F.col("__n") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
        doubled = sized.withColumn("__keep", F.explode(alone))
        nonce = F.col("__keep") == 0
        top = doubled.select(
            "qid",
            F.when(nonce, 0).otherwise(F.col("rank")).alias("rank"),
            F.when(nonce, "empty").otherwise(F.col("text")).alias("text"),
            F.when(nonce, 0.0).otherwise(F.col("start_logit")).alias("start_logit"),
            F.when(nonce, 0.0).otherwise(F.col("end_logit")).alias("end_logit"),
        )
        # Make ranks start at 1 again where a nonce was put in front.
        top = top.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("rank")))
    top = top.select("qid", "rank", "text", "start_logit", "end_logit")
    if questions is not None:
        filled = {"rank": F.lit(1), "text": F.lit(text), "start_logit": F.lit(value), "end_logit": F.lit(value)}
        top = questions.select("qid").join(top, "qid", "left").select(
            "qid", *[F.coalesce(c, v).alias(c) for c, v in filled.items()]
        )
    scored = top.withColumn("__s", F.col("start_logit") + F.col("end_logit"))
    whole = Window.partitionBy("qid")
    weight = F.exp(F.col("__s") - F.max("__s").over(whole))
    return (
        scored.withColumn("__w", weight)
        .withColumn("probability", F.col("__w") / F.sum("__w").over(whole))
        .drop("__s", "__w")
    )


def softmax_within(
    df: DataFrame, key: Sequence[str], score: str, out: str = "probability", *, spread: Sequence[str]
) -> DataFrame:
    """Add the softmax of ``score`` over the rows of a key, shifted by the maximum.

    Groups of any size: maximum and sum are aggregates, joined back with hot
    keys dealt over several tasks by ``spread``. Rows with a null key form a
    group like any other.
    """
    keys = list(key)
    hot = hot_keys(df.select(*keys), keys)
    how = {"spread": spread, "hot": hot, "null_safe": True}
    peak = df.groupBy(*keys).agg(F.max(score).alias("__m"))
    shifted = spread_join(df, peak, keys, **how).withColumn("__w", F.exp(F.col(score) - F.col("__m")))
    total = shifted.groupBy(*keys).agg(F.max("__m").alias("__m"), F.sum("__w").alias("__t"))
    return (
        spread_join(df, total, keys, **how)
        .withColumn(out, F.exp(F.col(score) - F.col("__m")) / F.col("__t"))
        .drop("__m", "__t")
    )


def best_answer(nbest: DataFrame, nulls: DataFrame | None = None, threshold: float = 0.0) -> DataFrame:
    """The answer of each question.

    Without ``nulls`` the first of the list: (qid, text). With ``nulls`` the
    empty text if the no-answer score exceeds the best non-empty answer by more
    than ``threshold``: (qid, text, score_diff).
    """
    if nulls is None:
        return nbest.groupBy("qid").agg(F.min_by("text", "rank").alias("text"))
    top = nbest.where(F.col("text") != "").groupBy("qid").agg(
        F.min(F.struct("rank", "text", (F.col("start_logit") + F.col("end_logit")).alias("s"))).alias("b")
    )
    diff = F.round(F.col("score_null") - F.col("b.s"), DIGITS)
    return top.join(nulls.select("qid", "score_null"), "qid").select(
        "qid", F.when(diff > threshold, "").otherwise(F.col("b.text")).alias("text"), diff.alias("score_diff")
    )


def span_candidates_topk(
    results: DataFrame, features: DataFrame, start_n: int = 5, end_n: int = 5, max_answer: int = 30
) -> DataFrame:
    """Candidates of a model that returns its own best starts and, per start, ends.

    ``results`` is (unique_id, start_top_log_probs, start_top_index,
    end_top_log_probs, end_top_index); the end list holds ``end_n`` entries per
    start. Both indexes must be below paragraph length - 1.
    """
    names = ["start_top_log_probs", "start_top_index", "end_top_log_probs", "end_top_index"]
    joined = features.join(results.select("unique_id", *names), "unique_id")
    limit = F.col("paragraph_len") - 1
    pairs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(start_n - 1)),
            lambda i: F.transform(
                F.sequence(F.lit(0), F.lit(end_n - 1)),
                lambda j: F.struct(
                    F.get("start_top_index", i).cast("int").alias("start"),
                    F.get("end_top_index", i * end_n + j).cast("int").alias("end"),
                    F.get("start_top_log_probs", i).cast("double").alias("start_logit"),
                    F.get("end_top_log_probs", i * end_n + j).cast("double").alias("end_logit"),
                    i.alias("start_rank"),
                    j.alias("end_rank"),
                ),
            ),
        )
    )
    valid = F.filter(
        pairs,
        lambda p: (p["start"] < limit)
        & (p["end"] < limit)
        & F.coalesce(F.get("is_max_context", p["start"]), F.lit(False))
        & (p["end"] >= p["start"])
        & (p["end"] - p["start"] < max_answer),
    )
    return joined.select(*features.columns, F.inline(valid))


def null_scores_topk(results: DataFrame, features: DataFrame) -> DataFrame:
    """Per question the smallest CLS score of its windows: (qid, score_null)."""
    joined = features.select("unique_id", "qid").join(results.select("unique_id", "cls_logit"), "unique_id")
    return joined.groupBy("qid").agg(
        F.least(F.min(F.col("cls_logit").cast("double")), F.lit(1e6)).alias("score_null")
    )


def nbest_spans_topk(cands: DataFrame, n: int = 20, questions: DataFrame | None = None) -> DataFrame:
    """``nbest_spans`` with an empty text at -1e6 for questions without candidates."""
    return nbest_spans(cands, n, questions, fallback=("", -1e6))
