"""Question-answering data preparation over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.functions.arrays import bind, compute_once, entries
from lexiloom.operators import ngrams as N
from lexiloom.operators import qa_prep as Q
from lexiloom.operators.segment import hot_from_counts
from lexiloom.plans.bindings import (
    NQ_SQL,
    SQUAD_SQL,
    SYNONYM_SQL,
    nq_rows,
    pieces,
    squad_rows,
    synonyms,
)
from lexiloom.plans.registry import query, text_table
from lexiloom.plans.sqltext import qa_tok, tok
from lexiloom.session import cut_lineage, cut_to_columns

# Token spans of the answers, and whether the answer is found again.
EXAMPLES = f"""
    q AS MATERIALIZED ({SQUAD_SQL}),
    sp AS (SELECT *, CASE WHEN is_impossible THEN -1
             ELSE len({qa_tok('substr(context, 1, answer_start + 1)')}) - 1 END AS s,
           CASE WHEN is_impossible THEN -1
             ELSE len({qa_tok('substr(context, 1, answer_start + length(answer))')}) - 1 END AS e FROM q),
    ex AS MATERIALIZED (SELECT *, is_impossible OR contains(array_to_string(toks[s + 1:e + 1], ' '),
             array_to_string({tok('answer')}, ' ')) AS ok FROM sp)
"""


@query(
    "squad_examples",
    f"""
    WITH {EXAMPLES}
    SELECT qid, md5(array_to_string(toks, ' ')) AS digest, CAST(s AS BIGINT) AS start_position,
           CAST(e AS BIGINT) AS end_position, coalesce(answer, '') AS orig_answer_text, is_impossible
    FROM ex WHERE ok
    """,
)
def _examples(spark, sf):
    return Q.squad_examples(squad_rows(spark, sf), True, True).select(
        "qid",
        F.md5(F.array_join("doc_tokens", " ")).alias("digest"),
        F.col("start_position").cast("bigint"),
        F.col("end_position").cast("bigint"),
        "orig_answer_text",
        "is_impossible",
    )


@query(
    "char_span_to_token_span",
    f"""
    WITH {EXAMPLES} SELECT qid, CAST(s AS BIGINT) AS start, CAST(e AS BIGINT) AS "end" FROM ex WHERE NOT is_impossible
    """,
)
def _span(spark, sf):
    r = squad_rows(spark, sf).where(~F.col("is_impossible")).withColumn("a", F.get("answers", 0))
    span = Q.char_span_to_token_span(F.col("context"), F.col("a.answer_start"), F.length("a.text"))
    return r.select("qid", span.alias("s")).select(
        "qid", F.col("s.start").cast("bigint").alias("start"), F.col("s.end").cast("bigint").alias("end")
    )


@query(
    "recoverable_answers",
    f"""
    WITH {EXAMPLES} SELECT CAST(count(CASE WHEN NOT ok THEN 1 END) AS BIGINT) AS dropped,
      CAST(count(CASE WHEN ok THEN 1 END) AS BIGINT) AS kept FROM ex
    """,
)
def _recoverable(spark, sf):
    return Q.unrecoverable_count(squad_rows(spark, sf), True)


@query(
    "augment_with_synonyms",
    f"""
    WITH {EXAMPLES}, syn AS ({SYNONYM_SQL})
    SELECT qid, coalesce(synonym, toks[s + 1]) AS replaced FROM ex LEFT JOIN syn ON syn.word = toks[s + 1]
    WHERE ok AND NOT is_impossible
    """,
)
def _synonyms(spark, sf):
    ex = Q.squad_examples(squad_rows(spark, sf), True, True).where(~F.col("is_impossible"))
    words = ex.select("qid", F.get(F.col("doc_tokens"), F.col("start_position")).alias("w"))
    return Q.augment_with_synonyms(words, synonyms(spark, sf), "w", "replaced", spread=["qid"]).select(
        "qid", "replaced"
    )


@query(
    "augment_answers",
    f"""
    WITH {EXAMPLES}, syn AS ({SYNONYM_SQL}),
    o AS (SELECT *, row_number() OVER (ORDER BY qid) - 1 AS rk FROM ex WHERE ok AND NOT is_impossible)
    SELECT qid, 0 AS copy, coalesce(answer, '') AS orig_answer_text FROM ex WHERE ok
    UNION ALL
    SELECT qid, 1 AS copy, CASE WHEN rk < 0.7 * (SELECT count(*) FROM o) THEN array_to_string(list_prepend(coalesce(synonym, toks[s + 1]),
           toks[s + 2:e + 1]), ' ') ELSE answer END AS orig_answer_text
    FROM o LEFT JOIN syn ON syn.word = toks[s + 1]
    """,
)
def _augment(spark, sf):
    ex = Q.squad_examples(squad_rows(spark, sf), True, True)
    return Q.augment_answers(ex, synonyms(spark, sf), columns=["qid", "orig_answer_text"]).select("qid", "copy", "orig_answer_text")


@query("with_short_answer", f"SELECT qid AS example_id FROM ({NQ_SQL}) WHERE has_short")
def _short(spark, sf):
    return Q.with_short_answer(nq_rows(spark, sf)).select("example_id")


@query(
    "nq_examples",
    rf"""
    WITH q AS ({NQ_SQL}),
    c AS (SELECT qid, toks[ls + 1:le] AS ctx, ss - ls AS s, se - ls AS e FROM q WHERE has_short),
    m AS (SELECT *, list_filter(ctx, lambda t: NOT regexp_matches(t, '^<[^>]+>')) AS kept,
            s - len(list_filter(ctx[1:s], lambda t: regexp_matches(t, '^<[^>]+>'))) AS s2,
            e - len(list_filter(ctx[1:e], lambda t: regexp_matches(t, '^<[^>]+>'))) AS e2 FROM c)
    SELECT qid, md5(array_to_string(kept, ' ')) AS digest, CAST(s2 AS BIGINT) AS start_position,
           CAST(e2 AS BIGINT) AS end_position, array_to_string(kept[s2 + 1:e2], ' ') AS orig_answer_text FROM m
    """,
)
def _nq(spark, sf):
    return Q.nq_examples(Q.with_short_answer(nq_rows(spark, sf))).select(
        "qid",
        F.md5(F.array_join("doc_tokens", " ")).alias("digest"),
        F.col("start_position").cast("bigint"),
        F.col("end_position").cast("bigint"),
        "orig_answer_text",
    )


QUERY_LEN = 10
ROOM = 384 - QUERY_LEN - 3
WINDOWS = f"""
    dt AS (SELECT doc_id, len({tok('text')}) AS n FROM documents),
    dw AS (SELECT doc_id, n, unnest(range(0, 1 + CAST(greatest(0, ceil((n - {ROOM}) / 128.0)) AS BIGINT))) AS w
           FROM dt WHERE n > 0),
    win AS (SELECT doc_id, n, w, w * 128 AS s, least({ROOM}, n - w * 128) AS l FROM dw)
"""


def doc_lengths(spark, sf):
    return text_table(spark, sf, "documents", "doc_id").select("doc_id", F.size(T.tokens(F.col("text"))).alias("n"))


def windows_of(spark, sf):
    return Q.doc_windows(doc_lengths(spark, sf), F.col("n"), F.lit(QUERY_LEN))


@query(
    "doc_windows",
    f"""
    WITH {WINDOWS} SELECT doc_id, CAST(w AS BIGINT) AS "window", CAST(s AS BIGINT) AS start,
      CAST(l AS BIGINT) AS length FROM win
    """,
)
def _windows(spark, sf):
    w = windows_of(spark, sf)
    return w.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("window", "start", "length")])


@query(
    "max_context",
    f"""
    WITH {WINDOWS}, p AS (SELECT doc_id, w, s, l, unnest(range(s, s + l)) AS pos FROM win),
    r AS (SELECT doc_id, w, pos, row_number() OVER (PARTITION BY doc_id, pos
            ORDER BY least(pos - s, s + l - 1 - pos) + 0.01::DOUBLE * l DESC, w) AS rn FROM p)
    SELECT doc_id, CAST(w AS BIGINT) AS "window", CAST(count(CASE WHEN rn = 1 THEN 1 END) AS BIGINT) AS n_best,
           CAST(coalesce(sum(CASE WHEN rn = 1 THEN pos END), 0) AS BIGINT) AS pos_sum
    FROM r GROUP BY doc_id, w
    """,
)
def _max_context(spark, sf):
    w = Q.max_context(windows_of(spark, sf))
    first, last = F.col("context_from").cast("bigint"), F.col("context_to").cast("bigint")
    return w.select(
        "doc_id",
        F.col("window").cast("bigint").alias("window"),
        F.size(F.filter("is_max_context", lambda b: b)).cast("bigint").alias("n_best"),
        F.when(last >= first, F.floor((first + last) * (last - first + 1) / 2)).otherwise(0).alias("pos_sum"),
    )


SUBTOKENS = """
    cut AS (SELECT *, list_transform(toks, lambda t: CASE WHEN length(t) > 4
              THEN [substr(t, 1, 4), '##' || substr(t, 5)] ELSE [t] END) AS pcs FROM ex),
    sub AS MATERIALIZED (SELECT *, flatten(pcs) AS st,
              flatten(list_transform(pcs, lambda p, i: list_transform(p, lambda x: i - 1))) AS t2o FROM cut)
"""


@query(
    "project_subtoken_index",
    f"""
    WITH {EXAMPLES}, {SUBTOKENS},
    o AS (SELECT qid, unnest(t2o) AS orig, generate_subscripts(t2o, 1) - 1 AS i FROM sub),
    f AS (SELECT qid, orig, min(i) AS first FROM o GROUP BY qid, orig)
    SELECT s.qid, CAST(len(st) AS BIGINT) AS n_sub, md5(array_to_string(st, ' ')) AS digest,
           CAST(list_sum(t2o) AS BIGINT) AS tok_to_orig_sum,
           CAST((SELECT sum(first) FROM f WHERE f.qid = s.qid) AS BIGINT) AS orig_to_tok_sum
    FROM sub s WHERE len(toks) > 0
    UNION ALL SELECT qid, 0, md5(''), 0, 0 FROM sub WHERE len(toks) = 0
    """,
)
def _subtokens(spark, sf):
    r = squad_rows(spark, sf)
    toks = compute_once(r, ["qid"], T.qa_tokens(F.col("context")).alias("toks"))
    m = compute_once(toks, ["qid"], Q.project_subtoken_index(F.col("toks"), pieces).alias("m"))
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda t, x: t + x)
    return m.select(
        "qid",
        F.size("m.sub_tokens").cast("bigint").alias("n_sub"),
        F.md5(F.array_join("m.sub_tokens", " ")).alias("digest"),
        total(F.col("m.tok_to_orig")).alias("tok_to_orig_sum"),
        total(F.col("m.orig_to_tok")).alias("orig_to_tok_sum"),
    )


# Sub-token span of the answer, tightened to the pieces of the answer text.
TIGHT = f"""
    {EXAMPLES}, {SUBTOKENS},
    an AS (SELECT qid, flatten(list_transform({tok('answer')}, lambda t: CASE WHEN length(t) > 4
             THEN [substr(t, 1, 4), '##' || substr(t, 5)] ELSE [t] END)) AS ans FROM ex WHERE ok AND NOT is_impossible),
    ps AS (SELECT sub.qid, st, ans, list_position(t2o, s) - 1 AS a,
             CASE WHEN e < len(toks) - 1 THEN list_position(t2o, e + 1) - 2 ELSE len(st) - 1 END AS z
           FROM sub JOIN an USING (qid)),
    hit AS (SELECT *, list_filter(range(a, z - len(ans) + 2), lambda i: st[i + 1:i + len(ans)] = ans)[1] AS h FROM ps),
    tight AS MATERIALIZED (SELECT qid, coalesce(h, a) AS ts, CASE WHEN h IS NULL THEN z ELSE h + len(ans) - 1 END AS te
             FROM hit)
"""


def example_subtokens(spark, sf):
    """Training examples with sub-tokens and the tightened answer span."""
    ex = Q.squad_examples(squad_rows(spark, sf), True, True)
    m = compute_once(
        ex,
        ["qid", "question", "doc_tokens", "orig_answer_text", "start_position", "end_position", "is_impossible"],
        Q.project_subtoken_index(F.col("doc_tokens"), pieces).alias("m"),
    ).select("*", "m.*")
    span = Q.subtoken_span(
        F.col("orig_to_tok"), F.size("sub_tokens"), F.col("start_position"), F.col("end_position")
    )
    answer = F.flatten(F.transform(T.tokens(F.col("orig_answer_text")), pieces))
    tight = bind(
        F.struct(span.alias("sp"), answer.alias("ans")),
        lambda v: Q.tighten_answer_span(F.col("sub_tokens"), v["sp"]["start"], v["sp"]["end"], v["ans"]),
    )
    wide = compute_once(
        m,
        ["qid", "question", "doc_tokens", "sub_tokens", "tok_to_orig", "is_impossible"],
        F.when(~F.col("is_impossible"), tight).alias("tight"),
    )
    return wide.select(
        "qid",
        "question",
        "doc_tokens",
        "sub_tokens",
        "tok_to_orig",
        F.col("is_impossible").alias("impossible"),
        F.coalesce("tight.start", F.lit(-1)).alias("tok_start"),
        F.coalesce("tight.end", F.lit(-1)).alias("tok_end"),
    )


@query(
    "tighten_answer_span",
    f"WITH {TIGHT} SELECT qid, CAST(ts AS BIGINT) AS tok_start, CAST(te AS BIGINT) AS tok_end FROM tight",
)
def _tighten(spark, sf):
    e = example_subtokens(spark, sf).where(~F.col("impossible"))
    return e.select("qid", F.col("tok_start").cast("bigint"), F.col("tok_end").cast("bigint"))


FEATURES = f"""
    {TIGHT},
    fx AS (SELECT sub.qid, st, t2o, is_impossible AS imp, coalesce(ts, -1) AS ts, coalesce(te, -1) AS te,
             flatten(list_transform({tok('question')}, lambda t: CASE WHEN length(t) > 4
               THEN [substr(t, 1, 4), '##' || substr(t, 5)] ELSE [t] END))[1:64] AS qt
           FROM sub LEFT JOIN tight USING (qid) WHERE ok),
    fr AS (SELECT *, len(st) AS n, 384 - len(qt) - 3 AS room FROM fx WHERE len(st) > 0),
    fw AS (SELECT *, unnest(range(0, 1 + CAST(greatest(0, ceil((n - room) / 128.0)) AS BIGINT))) AS w FROM fr),
    f AS (SELECT *, w * 128 AS s, least(room, n - w * 128) AS l FROM fw)
"""


def features(spark, sf, **layout):
    ex = example_subtokens(spark, sf)
    asked = ex.withColumn("query_tokens", Q.query_tokens(F.flatten(F.transform(T.tokens(F.col("question")), pieces))))
    windows = Q.doc_windows(
        asked, F.size("sub_tokens"), F.size("query_tokens"), cuts=Q.feature_cuts(), leave=["doc_tokens"]
    )
    return Q.window_answer_span(Q.assemble_features(Q.max_context(windows), **layout))


def _total(name):
    return F.aggregate(name, F.lit(0).cast("bigint"), lambda t, x: t + F.coalesce(x.cast("bigint"), F.lit(0).cast("bigint")))


def feature_report(f):
    return f.select(
        "qid",
        F.col("window").cast("bigint").alias("window"),
        F.md5(F.array_join("tokens", " ")).alias("digest"),
        _total("token_to_orig").alias("orig_sum"),
        _total("input_mask").alias("mask_sum"),
        _total("segment_ids").alias("segment_sum"),
        _total("p_mask").alias("p_mask_sum"),
        (F.size("input_mask") + F.size("segment_ids") + F.size("p_mask")).cast("bigint").alias("padded"),
        F.col("cls_index").cast("bigint").alias("cls_index"),
    )


@query(
    "assemble_features",
    f"""
    WITH {FEATURES}
    SELECT qid, CAST(w AS BIGINT) AS "window",
           md5(array_to_string(flatten([['[CLS]'], qt, ['[SEP]'], st[s + 1:s + l], ['[SEP]']]), ' ')) AS digest,
           CAST(list_sum(t2o[s + 1:s + l]) AS BIGINT) AS orig_sum, CAST(len(qt) + l + 3 AS BIGINT) AS mask_sum,
           CAST(l + 1 AS BIGINT) AS segment_sum, CAST(384 - l - 1 AS BIGINT) AS p_mask_sum,
           CAST(384 * 3 AS BIGINT) AS padded, CAST(0 AS BIGINT) AS cls_index
    FROM f
    """,
)
def _features(spark, sf):
    return feature_report(features(spark, sf))


@query(
    "assemble_features_doc_first",
    f"""
    WITH {FEATURES}
    SELECT qid, CAST(w AS BIGINT) AS "window",
           md5(array_to_string(flatten([st[s + 1:s + l], ['[SEP]'], qt, ['[SEP]', '[CLS]']]), ' ')) AS digest,
           CAST(list_sum(t2o[s + 1:s + l]) AS BIGINT) AS orig_sum, CAST(len(qt) + l + 3 AS BIGINT) AS mask_sum,
           CAST(len(qt) + 1 + 2 + 4 * (384 - len(qt) - l - 3) AS BIGINT) AS segment_sum,
           CAST(384 - l - 1 AS BIGINT) AS p_mask_sum,
           CAST(384 * 3 AS BIGINT) AS padded, CAST(len(qt) + l + 2 AS BIGINT) AS cls_index
    FROM f
    """,
)
def _features_doc_first(spark, sf):
    return feature_report(
        features(
            spark, sf, cls_token_at_end=True, sequence_a_is_doc=True, cls_token_segment_id=2, pad_token_segment_id=4
        )
    )


@query(
    "window_answer_span",
    f"""
    WITH {FEATURES}, i AS (SELECT *, NOT imp AND ts >= s AND te <= s + l - 1 AS inside FROM f)
    SELECT qid, CAST(w AS BIGINT) AS "window",
           CAST(CASE WHEN inside THEN ts - s + len(qt) + 2 ELSE 0 END AS BIGINT) AS start_position,
           CAST(CASE WHEN inside THEN te - s + len(qt) + 2 ELSE 0 END AS BIGINT) AS end_position,
           NOT inside AS is_impossible FROM i
    """,
)
def _answer_span(spark, sf):
    return features(spark, sf).select(
        "qid",
        *[F.col(c).cast("bigint").alias(c) for c in ("window", "start_position", "end_position")],
        "is_impossible",
    )


@query(
    "encode_features",
    f"""
    WITH {FEATURES},
    c AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) + 3 AS ix
          FROM (SELECT unnest(st) AS term FROM sub WHERE ok) GROUP BY term),
    v AS (SELECT * FROM c),
    t AS (SELECT qid, unnest(st) AS term, generate_subscripts(st, 1) - 1 AS pos FROM fx),
    d AS (SELECT qid, pos, coalesce(ix, 0) AS ix FROM t LEFT JOIN v USING (term)),
    qd AS (SELECT qid, sum(coalesce(ix, 0)) AS qs FROM (SELECT qid, unnest(qt) AS term FROM fx) LEFT JOIN v USING (term)
           GROUP BY qid)
    SELECT f.qid, CAST(f.w AS BIGINT) AS "window", CAST(384 AS BIGINT) AS n_ids,
           CAST(2 + 2 * 3 + any_value(coalesce(qs, 0)) + sum(d.ix) + 1 * (384 - any_value(len(qt) + l) - 3) AS BIGINT)
             AS id_sum
    FROM f JOIN d ON d.qid = f.qid AND d.pos >= s AND d.pos < s + l LEFT JOIN qd ON qd.qid = f.qid GROUP BY f.qid, f.w
    """,
)
def _encode(spark, sf):
    # The vocabulary, the look-ups and the windows read the sub-tokens, which are cut once.
    ex = cut_to_columns(example_subtokens(spark, sf))
    terms = ex.select(F.explode(entries(F.col("sub_tokens"))).alias("term"))
    vocab = N.frequency_vocab(terms, None, ("<unk>", "<pad>", "[CLS]", "[SEP]"))
    asked = ex.withColumn("query_tokens", Q.query_tokens(F.flatten(F.transform(T.tokens(F.col("question")), pieces))))
    columns = {"sub_tokens": "sub_ids", "query_tokens": "query_ids"}
    vocab = cut_lineage(vocab)
    coded = Q.encode_arrays(asked, "qid", columns, vocab, 0, hot=hot_from_counts(vocab, ["term"], "cnt"))
    windows = Q.max_context(
        Q.doc_windows(
            coded, F.size("sub_tokens"), F.size("query_tokens"), cuts=Q.feature_cuts(ids=True), leave=["doc_tokens"]
        )
    )
    f = Q.assemble_features(windows, ids=(2, 3, 1))
    return f.select(
        "qid",
        F.col("window").cast("bigint").alias("window"),
        F.size("input_ids").cast("bigint").alias("n_ids"),
        _total("input_ids").alias("id_sum"),
    )


@query("count_examples", "SELECT CAST(count(*) AS BIGINT) AS n FROM pages")
def _count(spark, sf):
    return Q.count_examples(nq_rows(spark, sf))
