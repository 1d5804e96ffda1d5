"""Column transforms over the documents, pages, conversations and events tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.operators.tags import noise_tokens
from lexiloom.functions.arrays import compute_once
from lexiloom.plans.bindings import EVENT_TAGS_SQL, gold_tag, pieces
from lexiloom.plans.registry import query, table, text_table
from lexiloom.plans.sqltext import normalized, stripped, tok, token_stream

ALPHABET_SQL = "concat(" + ", ".join(f"chr({ord(c)})" for c in T.ALPHABET) + ")"


@query(
    "tokens",
    f"""
    SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, md5(array_to_string(toks, ' ')) AS digest
    FROM (SELECT doc_id, {tok('text')} AS toks FROM documents)
    """,
)
def _tokens(spark, sf):
    d = text_table(spark, sf, "documents", "doc_id").select("doc_id", T.tokens(F.col("text")).alias("toks"))
    return d.select(
        "doc_id",
        F.size("toks").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("toks", " ")).alias("digest"),
    )


@query(
    "tokens_with_offsets",
    rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(text, '(?s).') AS cs FROM documents),
    c AS (SELECT doc_id, unnest(cs) AS ch, generate_subscripts(cs, 1) - 1 AS i FROM d),
    b AS (SELECT doc_id, i, ch IN (' ', chr(9), chr(10), chr(13), chr(8239)) AS blank FROM c),
    s AS (SELECT doc_id, i, (NOT blank AND coalesce(lag(blank) OVER (PARTITION BY doc_id ORDER BY i), true)) AS st
          FROM b),
    m AS (SELECT doc_id, i, st, sum(CASE WHEN st THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i
          ROWS UNBOUNDED PRECEDING) - 1 AS ix FROM s)
    SELECT doc_id, CAST(count(*) AS BIGINT) AS n_chars,
           CAST(sum(CASE WHEN st THEN 1 ELSE 0 END) AS BIGINT) AS n_tokens,
           CAST(sum(CASE WHEN st THEN i * (ix + 1) ELSE 0 END) AS BIGINT) AS start_sum,
           CAST(sum(ix) AS BIGINT) AS map_sum
    FROM m GROUP BY doc_id
    UNION ALL SELECT doc_id, 0, 0, 0, 0 FROM documents WHERE text = ''
    """,
)
def _offsets(spark, sf):
    d = text_table(spark, sf, "documents", "doc_id")
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda t, x: t + x)
    return d.select(
        "doc_id", T.token_starts(F.col("text")).alias("starts"), T.char_to_token(F.col("text")).alias("map")
    ).select(
        "doc_id",
        F.size("map").cast("bigint").alias("n_chars"),
        F.size("starts").cast("bigint").alias("n_tokens"),
        total(F.transform("starts", lambda s, i: s.cast("bigint") * (i + 1))).alias("start_sum"),
        total(F.transform("map", lambda m: m.cast("bigint"))).alias("map_sum"),
    )


@query("normalize_answer", f"SELECT conv_id, turn, {normalized('text')} AS answer FROM conversations")
def _normalize(spark, sf):
    return text_table(spark, sf, "conversations", "conv_id", "turn").select(
        "conv_id", "turn", T.normalize_answer(F.col("text")).alias("answer")
    )


@query(
    "drop_markup_tokens",
    rf"""
    WITH p AS (SELECT page_id, {tok('html')} AS toks FROM pages),
    t AS (SELECT page_id, unnest(toks) AS tk, generate_subscripts(toks, 1) - 1 AS i FROM p),
    m AS (SELECT page_id, tk, i, CASE WHEN regexp_matches(tk, '^<[^>]+>') THEN 1 ELSE 0 END AS mk FROM t),
    c AS (SELECT *, sum(mk) OVER (PARTITION BY page_id ORDER BY i ROWS UNBOUNDED PRECEDING) - mk AS before FROM m)
    SELECT page_id, CAST(sum(1 - mk) AS BIGINT) AS n_kept,
           md5(coalesce(string_agg(tk, ' ' ORDER BY i) FILTER (WHERE mk = 0), '')) AS digest,
           CAST(sum(before) AS BIGINT) AS before_sum
    FROM c GROUP BY page_id
    UNION ALL SELECT page_id, 0, md5(''), 0 FROM p WHERE len(toks) = 0
    """,
)
def _markup(spark, sf):
    p = compute_once(text_table(spark, sf, "pages", "page_id"), ["page_id"], T.tokens(F.col("html")).alias("toks"))
    return p.select(
        "page_id",
        F.size(T.drop_markup_tokens(F.col("toks"))).cast("bigint").alias("n_kept"),
        F.md5(F.array_join(T.drop_markup_tokens(F.col("toks")), " ")).alias("digest"),
        F.aggregate(
            T.markup_before(F.col("toks")), F.lit(0).cast("bigint"), lambda t, x: t + x
        ).alias("before_sum"),
    )


@query(
    "semichar_features",
    f"""
    WITH w AS MATERIALIZED (SELECT DISTINCT term FROM ({token_stream('documents', 'doc_id')})),
    c AS (SELECT term, unnest(string_split(term, '')) AS ch, unnest(range(1, length(term) + 1)) AS i FROM w),
    p AS (SELECT term, i, length(term) AS n, strpos({ALPHABET_SQL}, ch) AS k FROM c),
    f AS (SELECT term, k - 1 AS ix FROM p WHERE i = 1 AND k > 0
          UNION ALL SELECT term, 99 + k FROM p WHERE 1 < i AND i < n AND k > 0
          UNION ALL SELECT term, 199 + k FROM p WHERE i = n AND k > 0),
    g AS (SELECT term, ix, count(*) AS n FROM f GROUP BY term, ix),
    s AS (SELECT term, string_agg(ix || ':' || n, ' ' ORDER BY ix) AS features FROM g GROUP BY term),
    u AS (SELECT term, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS unknown FROM p GROUP BY term)
    SELECT term, coalesce(features, '') AS features, CAST(unknown AS BIGINT) AS unknown
    FROM u LEFT JOIN s USING (term)
    """,
)
def _semichar(spark, sf):
    d = text_table(spark, sf, "documents", "doc_id").select(F.explode(T.tokens(F.col("text"))).alias("term")).distinct()
    return d.select(
        "term",
        F.array_join(
            F.transform(T.semichar_entries(F.col("term")), lambda e: F.concat_ws(":", e["ix"], e["n"])), " "
        ).alias("features"),
        T.unknown_chars(F.col("term")).cast("bigint").alias("unknown"),
    )


@query(
    "noise_tokens",
    f"""
    WITH t AS ({token_stream('documents', 'doc_id')}),
    d AS (SELECT *, (doc_id * 31 + pos * 17 + 7) % 3 AS act,
                 CASE WHEN length(term) > 2 THEN 1 + (doc_id * 13 + pos * 29 + 7) % (length(term) - 2) ELSE 0 END AS ix
          FROM t),
    n AS (SELECT doc_id, pos, CASE WHEN length(term) < 3 OR act = 0 THEN term
            WHEN act = 1 THEN substr(term, 1, ix) || substr(term, ix + 2)
            ELSE substr(term, 1, ix) || substr(term, ix + 2, 1) || substr(term, ix + 1, 1) || substr(term, ix + 3)
            END AS noisy FROM d)
    SELECT doc_id, md5(coalesce(string_agg(noisy, ' ' ORDER BY pos), '')) AS digest
    FROM documents LEFT JOIN n USING (doc_id) GROUP BY doc_id
    """,
)
def _noise(spark, sf):
    d = compute_once(text_table(spark, sf, "documents", "doc_id"), ["doc_id"], T.tokens(F.col("text")).alias("toks"))
    return noise_tokens(d, 7, "doc_id", "toks").select("doc_id", F.md5(F.array_join("toks", " ")).alias("digest"))


@query(
    "join_wordpieces",
    f"""
    SELECT doc_id, md5(array_to_string({tok('glued')}, ' ')) AS digest FROM (
      SELECT doc_id, replace(replace(array_to_string(list_transform({tok('text')},
        lambda t: CASE WHEN length(t) > 4 THEN substr(t, 1, 4) || ' ##' || substr(t, 5) ELSE t END), ' '),
        ' ##', ''), '##', '') AS glued FROM documents)
    """,
)
def _wordpieces(spark, sf):
    d = text_table(spark, sf, "documents", "doc_id")
    split = F.flatten(F.transform(T.tokens(F.col("text")), pieces))
    return d.select("doc_id", F.md5(T.join_wordpieces(split)).alias("digest"))


@query(
    "until_eos",
    f"""
    SELECT conv_id, turn, string_split({stripped("concat('  ', text, ' <EOS> ', role, ' <EOS>')")}, '<EOS>')[1]
           AS answer FROM conversations
    """,
)
def _until_eos(spark, sf):
    c = text_table(spark, sf, "conversations", "conv_id", "turn")
    marked = F.concat(F.lit("  "), F.col("text"), F.lit(" <EOS> "), F.col("role"), F.lit(" <EOS>"))
    return c.select("conv_id", "turn", T.until_eos(marked).alias("answer"))


@query(
    "split_tag",
    f"""
    SELECT event_id, CASE WHEN gold = 'O' THEN 'O' ELSE split_part(gold, '-', 1) END AS prefix,
           CASE WHEN gold = 'O' THEN NULL ELSE split_part(gold, '-', 2) END AS type
    FROM ({EVENT_TAGS_SQL})
    """,
)
def _split_tag(spark, sf):
    e = table(spark, sf, "events")
    tag = T.split_tag(gold_tag(F.col("event_type")))
    return e.select("event_id", tag.alias("t")).select("event_id", "t.prefix", "t.type")


