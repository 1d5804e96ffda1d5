"""From question-answering records to windowed feature rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.arrays import bind, compute_once, running_sum
from lexiloom.functions.text import (
    count_markup_before,
    drop_markup_tokens,
    qa_tokens,
    token_at,
    tokens,
)
from lexiloom.operators.ordered import positions
from lexiloom.operators.skew import lookup_join, spread_join


def char_span_to_token_span(context: Column, start: Column, length: Column) -> Column:
    """Token span (start, end), both inclusive, of a character span."""
    return F.struct(
        token_at(context, start).alias("start"), token_at(context, start + length - 1).alias("end")
    )


def span_of(arr: Column, start: Column, end: Column) -> Column:
    """Entries ``start`` to ``end``, both 0-based and inclusive."""
    return F.slice(arr, start + 1, F.greatest(end - start + 1, F.lit(0)))


def is_recoverable(doc_tokens: Column, start: Column, end: Column, answer: Column) -> Column:
    """True if the answer, with single spaces, occurs in the text of its token span."""
    return F.contains(F.array_join(span_of(doc_tokens, start, end), " "), F.array_join(tokens(answer), " "))


def _placed(df: DataFrame, training: bool, with_impossible: bool) -> DataFrame:
    base = compute_once(df, df.columns, qa_tokens(F.col("context")).alias("doc_tokens"))
    if not training:
        nothing = F.lit(None)
        return base.select(
            "qid",
            "question",
            "doc_tokens",
            nothing.cast("string").alias("orig_answer_text"),
            nothing.cast("int").alias("start_position"),
            nothing.cast("int").alias("end_position"),
            F.lit(False).alias("is_impossible"),
        )
    impossible = F.col("is_impossible") if with_impossible else F.lit(False)
    one = F.when(F.size("answers") == 1, F.get("answers", 0)).otherwise(
        F.raise_error(F.concat(F.lit("one answer expected for question "), F.col("qid").cast("string"))).cast(
            "struct<text:string,answer_start:int>"
        )
    )
    answer = F.when(~impossible, one)
    with_answer = base.withColumn("__imp", impossible).withColumn("__a", answer)
    span = char_span_to_token_span(F.col("context"), F.col("__a.answer_start"), F.length("__a.text"))
    minus = F.lit(-1)
    kept = ["qid", "question", "doc_tokens", "__imp", "__a"]
    return compute_once(with_answer, kept, F.when(~F.col("__imp"), span).alias("__s")).select(
        "qid",
        "question",
        "doc_tokens",
        F.when(F.col("__imp"), F.lit("")).otherwise(F.col("__a.text")).alias("orig_answer_text"),
        F.coalesce(F.col("__s.start"), minus).alias("start_position"),
        F.coalesce(F.col("__s.end"), minus).alias("end_position"),
        F.col("__imp").alias("is_impossible"),
    )


def _kept() -> Column:
    return F.col("is_impossible") | is_recoverable(
        F.col("doc_tokens"), F.col("start_position"), F.col("end_position"), F.col("orig_answer_text")
    )


def squad_examples(df: DataFrame, training: bool = False, with_impossible: bool = False) -> DataFrame:
    """Question rows (qid, question, context, answers, is_impossible) with document tokens.

    Training rows get their answer span and need exactly one answer unless they
    are impossible (span -1); rows whose answer cannot be found again in its
    span are dropped (see ``unrecoverable_count``). Other rows get null spans.
    """
    placed = _placed(df, training, with_impossible)
    return placed.where(_kept()) if training else placed


def unrecoverable_count(df: DataFrame, with_impossible: bool = False) -> DataFrame:
    """How many training rows ``squad_examples`` drops: one row (dropped, kept)."""
    flagged = _placed(df, True, with_impossible).select(_kept().alias("ok"))
    return flagged.agg(F.count_if(~F.col("ok")).alias("dropped"), F.count_if(F.col("ok")).alias("kept"))


def augment_with_synonyms(
    df: DataFrame, synonyms: DataFrame, word: str, out: str, rank: int = 2, *, spread: Sequence[str]
) -> DataFrame:
    """Add ``out``: the synonym of ``word`` at a rank, or the word itself.

    ``synonyms`` is (word, rank, synonym) with one row per word and rank.
    """
    second = synonyms.where(F.col("rank") == rank).select(F.col("word").alias(word), F.col("synonym").alias("__syn"))
    joined = spread_join(df, second, [word], "left", spread)
    return joined.withColumn(out, F.coalesce("__syn", word)).drop("__syn")


def augment_answers(
    examples: DataFrame,
    synonyms: DataFrame,
    share: float = 0.7,
    order: Sequence[str] = ("qid",),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every row, plus a copy (``copy`` = 1) of every answerable row. In the first
    ``share`` of the copies the first word of the answer span is replaced by a synonym.

    Gives ``columns`` of the rows, all of them if it is None. The copies are numbered and
    shuffled with these and the words of their answer, so leave out documents that nobody reads.
    """
    kept = list(examples.columns if columns is None else columns)
    carried = list(dict.fromkeys([*kept, *order, "orig_answer_text"]))
    first = F.get(F.col("doc_tokens"), F.col("start_position"))
    rest = span_of(F.col("doc_tokens"), F.col("start_position") + 1, F.col("end_position"))
    answerable = examples.where(~F.col("is_impossible")).select(*carried, first.alias("__w"), rest.alias("__rest"))
    numbered = positions(answerable, [], list(order), "__at")
    total = answerable.agg(F.count(F.lit(1))).scalar()
    swapped = augment_with_synonyms(numbered, synonyms, "__w", "__new", spread=list(order))
    text = F.array_join(F.concat(F.array("__new"), "__rest"), " ")
    copies = swapped.withColumn(
        "orig_answer_text", F.when(F.col("__at") < share * total, text).otherwise(F.col("orig_answer_text"))
    ).select(*kept, F.lit(1).alias("copy"))
    return examples.select(*kept, F.lit(0).alias("copy")).unionByName(copies)


def with_short_answer(df: DataFrame, annotations: str = "annotations") -> DataFrame:
    """Rows whose first annotation has at least one short answer."""
    return df.where(F.size(F.get(annotations, 0)["short_answers"]) >= 1)


def nq_examples(df: DataFrame) -> DataFrame:
    """Long/short answer rows as examples.

    The long answer is the context; the first short answer is moved into it and
    past the markup tokens that are dropped. ``end_position`` is exclusive.
    """
    first = F.get("annotations", 0)
    base = df.select(
        F.col("example_id").alias("qid"),
        F.col("question_text").alias("question"),
        qa_tokens(F.col("document_text")).alias("__all"),
        first["long_answer"].alias("__long"),
        F.get(first["short_answers"], 0).alias("__short"),
    )
    missing = F.raise_error(F.concat(F.lit("no short answer for question "), F.col("qid").cast("string"))).cast("int")
    origin = F.col("__long.start_token")
    sliced = compute_once(
        base,
        ["qid", "question", "__long", "__short"],
        span_of(F.col("__all"), origin, F.col("__long.end_token") - 1).alias("__ctx"),
    )
    s = F.coalesce(F.col("__short.start_token"), missing) - origin
    e = F.col("__short.end_token") - origin
    placed = compute_once(
        sliced,
        ["qid", "question"],
        drop_markup_tokens(F.col("__ctx")).alias("doc_tokens"),
        (s - count_markup_before(F.col("__ctx"), s)).alias("start_position"),
        (e - count_markup_before(F.col("__ctx"), e)).alias("end_position"),
    )
    return placed.select(
        "*",
        F.array_join(
            span_of(F.col("doc_tokens"), F.col("start_position"), F.col("end_position") - 1), " "
        ).alias("orig_answer_text"),
        F.lit(False).alias("is_impossible"),
    )


def project_subtoken_index(doc_tokens: Column, tokenizer: Callable[[Column], Column]) -> Column:
    """Sub-tokens of the tokens, with the index maps in both directions.

    ``tokenizer`` maps a token Column to an array Column of its pieces.
    """
    def ends_before(cut: Column) -> Column:
        return bind(
            F.transform(cut, lambda p: F.size(p)),
            lambda sizes: F.transform(running_sum(sizes), lambda end, i: end - F.element_at(sizes, i + 1)),
        )

    def firsts(origin: Column) -> Column:
        """Where another token begins."""
        places = F.when(F.size(origin) > 0, F.sequence(F.lit(0), F.size(origin) - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda j: (j == 0) | (F.get(origin, j) != F.get(origin, j - 1)))

    def maps(cut: Column) -> Column:
        origin = F.flatten(F.transform(cut, lambda p, i: F.array_repeat(i, F.size(p))))
        return bind(
            origin,
            lambda o: bind(
                firsts(o),
                # Sizes are added up only where a token has no piece and so does not begin anywhere.
                lambda f: F.struct(
                    F.flatten(cut).alias("sub_tokens"),
                    o.alias("tok_to_orig"),
                    F.when(F.size(f) == F.size(cut), f).otherwise(ends_before(cut)).alias("orig_to_tok"),
                ),
            ),
        )

    return bind(F.transform(doc_tokens, tokenizer), maps)


def subtoken_span(orig_to_tok: Column, n_sub: Column, start: Column, end: Column) -> Column:
    """Sub-token span of a token span; the last token reaches to the end."""
    return F.struct(
        F.get(orig_to_tok, start).alias("start"),
        F.when(end < F.size(orig_to_tok) - 1, F.get(orig_to_tok, end + 1) - 1).otherwise(n_sub - 1).alias("end"),
    )


def tighten_answer_span(sub_tokens: Column, start: Column, end: Column, answer_tokens: Column) -> Column:
    """The first sub-span that equals the tokenised answer, else the span itself."""
    n = F.size(answer_tokens)
    inside = span_of(sub_tokens, start, end)
    shifts = F.when((n > 0) & (n <= F.size(inside)), F.sequence(F.lit(0), F.size(inside) - n)).otherwise(
        F.array().cast("array<int>")
    )
    hit = F.get(F.filter(shifts, lambda i: F.slice(inside, i + 1, n) == answer_tokens), 0)
    return bind(
        hit,
        lambda h: F.struct(
            (start + F.coalesce(h, F.lit(0))).alias("start"),
            F.when(h.isNotNull(), start + h + n - 1).otherwise(end).alias("end"),
        ),
    )


def query_tokens(pieces: Column, max_query_length: int = 64) -> Column:
    """The question of a feature: its first ``max_query_length`` word pieces."""
    return F.slice(pieces, 1, max_query_length)


def doc_windows(
    df: DataFrame,
    n_tokens: Column,
    query_len: Column,
    max_len: int = 384,
    stride: int = 128,
    cuts: Mapping[str, Callable[[Column, Column], Column]] | None = None,
    leave: Sequence[str] = (),
) -> DataFrame:
    """One row per window of each document: adds (window, start, length) and the
    layout (room, step, n_windows, n_tokens, tail_from) that ``max_context`` needs.

    A window holds at most ``max_len`` - query - 3 tokens, and the last one ends
    with the document. ``cuts`` computes columns of the window from its start and
    length in the row of the document, so that a window never carries a whole
    document; arrays they are cut from and columns ``leave`` stay behind.
    """
    room = F.lit(max_len) - query_len - 3
    checked = F.when(room > 0, room).otherwise(F.raise_error(F.lit("no room for the document")).cast("int"))
    sized = compute_once(df, df.columns, n_tokens.alias("n_tokens"), checked.alias("room"))
    step = F.least(F.col("room"), F.lit(stride))
    more = F.greatest(F.lit(0), F.ceil((F.col("n_tokens") - F.col("room")) / step))
    laid = compute_once(
        sized, sized.columns, step.alias("step"), F.when(F.col("n_tokens") > 0, 1 + more).cast("int").alias("n_windows")
    )
    laid = laid.withColumn("tail_from", _tail_from())
    numbers = F.when(F.col("n_windows") > 0, F.sequence(F.lit(0), F.col("n_windows") - 1)).otherwise(
        F.array().cast("array<int>")
    )

    def window(w: Column) -> Column:
        start = w * F.col("step")
        length = F.least(F.col("room"), F.col("n_tokens") - start)
        cut = [make(start, length).alias(c) for c, make in (cuts or {}).items()]
        return F.struct(w.alias("window"), start.alias("start"), length.alias("length"), *cut)

    kept = [c for c in laid.columns if c not in (*(cuts or {}), *leave)]
    return laid.select(*kept, F.inline(F.transform(numbers, window)))


def feature_cuts(ids: bool = False) -> dict[str, Callable[[Column, Column], Column]]:
    """The ``cuts`` that ``assemble_features`` needs, of (sub_tokens, tok_to_orig,
    doc_tokens) and, with ``ids``, sub_ids. Leave ``doc_tokens`` behind."""

    def sliced(name: str) -> Callable[[Column, Column], Column]:
        return lambda start, length: F.slice(F.col(name), start + 1, length)

    def source_words(start: Column, length: Column) -> Column:
        return span_of(F.col("doc_tokens"), F.get("tok_to_orig", start), F.get("tok_to_orig", start + length - 1))

    names = ["sub_tokens", "tok_to_orig", *(["sub_ids"] if ids else [])]
    return {**{c: sliced(c) for c in names}, "orig_tokens": source_words}


def best_window(p: Column, layout: Callable[[str], Column] = F.col) -> Column:
    """The window in which token ``p`` has the most context.

    The score of a window is min(left, right) + 0.01 * length and the first
    window wins ties. All windows but the last are equally long, so the best of
    them is the one whose centre is nearest; only that one and the last compete.
    """
    n, room, step, last = layout("n_tokens"), layout("room"), layout("step"), layout("n_windows") - 1
    near = F.ceil((2 * p - room + 1 - step) / (2 * step)).cast("int")
    full = F.least(F.greatest(near, F.lit(0)), F.greatest(last - 1, F.lit(0)))
    full_left = p - full * step
    full_right = full * step + room - 1 - p
    tail = last * step
    full_score = F.least(full_left, full_right) + 0.01 * room
    tail_score = F.least(p - tail, n - 1 - p) + 0.01 * (n - tail)
    return (
        F.when(last == 0, 0)
        .when(p < tail, full)
        .when((F.least(full_left, full_right) < 0) | (tail_score > full_score), last)
        .otherwise(full)
    )


def _tail_from() -> Column:
    """The first token that the last window shows best, searched once per
    document. From there on it stays the best: its left context grows while the
    right context of the windows before it shrinks."""
    last = F.col("n_windows") - 1
    tail = last * F.col("step")
    covered = (last - 1) * F.col("step") + F.col("room") - 1
    hits = F.filter(
        F.when(tail <= covered, F.sequence(tail, covered)).otherwise(F.array().cast("array<int>")),
        lambda p: best_window(p) == last,
    )
    return F.when(last == 0, 0).otherwise(F.coalesce(F.get(hits, 0), F.greatest(covered + 1, tail)))


def max_context(windows: DataFrame) -> DataFrame:
    """Add ``is_max_context``: per token of the window, whether no other window
    of the document shows it with more context. These tokens are a run, from
    ``context_from`` to ``context_to``."""
    w, start, end = F.col("window"), F.col("start"), F.col("start") + F.col("length") - 1
    last, tail = F.col("n_windows") - 1, F.col("tail_from")
    upto = lambda k: F.floor((2 * k * F.col("step") + F.col("step") + F.col("room") - 1) / 2).cast("int")
    first = F.when(w == last, tail).when(w == 0, 0).otherwise(F.greatest(start, upto(w - 1) + 1))
    final = F.when(w == last, end).otherwise(
        F.least(end, tail - 1, F.when(w == last - 1, end).otherwise(upto(w)))
    )
    run = windows.withColumn("context_from", first).withColumn("context_to", final)
    lo, hi = F.col("context_from"), F.col("context_to")
    flags = F.when(
        hi >= lo,
        F.concat(
            F.array_repeat(F.lit(False), lo - start),
            F.array_repeat(F.lit(True), hi - lo + 1),
            F.array_repeat(F.lit(False), end - hi),
        ),
    ).otherwise(F.array_repeat(F.lit(False), F.col("length")))
    return run.withColumn("is_max_context", flags)


def assemble_features(
    df: DataFrame,
    max_len: int = 384,
    cls_token: str = "[CLS]",
    sep_token: str = "[SEP]",
    cls_token_at_end: bool = False,
    sequence_a_is_doc: bool = False,
    cls_token_segment_id: int = 0,
    pad_token_segment_id: int = 0,
    mask_padding_with_zero: bool = True,
    ids: tuple[int, int, int] | None = None,
) -> DataFrame:
    """Lay out a window for a reader model: ``[CLS] query [SEP] passage [SEP]``,
    or the passage first and ``[CLS]`` at the end.

    Takes ``max_context`` rows with query_tokens and the columns of
    ``feature_cuts``, all cut to the window. ``token_to_orig`` and ``is_max_context`` are aligned to
    ``tokens`` and null outside the passage. With ``ids`` = (cls, sep, pad) and
    the columns (query_ids, sub_ids), ``input_ids`` is added.
    """
    length = F.col("length")
    q = F.size("query_tokens")
    zero, one = F.lit(0), F.lit(1)
    b = 0 if sequence_a_is_doc else 1

    def lay(cls: Column, query: Column, sep1: Column, passage: Column, sep2: Column) -> Column:
        body = [passage, sep1, query, sep2] if sequence_a_is_doc else [query, sep1, passage, sep2]
        return F.concat(*([*body, cls] if cls_token_at_end else [cls, *body]))

    def cells(cls: Column, query: Column, sep1: Column, passage: Column, sep2: Column) -> Column:
        return lay(
            F.array(cls), F.array_repeat(query, q), F.array(sep1), F.array_repeat(passage, length), F.array(sep2)
        )

    none_int, none_flag = F.lit(None).cast("int"), F.lit(None).cast("boolean")
    n = q + length + 3
    pad = F.lit(max_len) - n
    on, off = (1, 0) if mask_padding_with_zero else (0, 1)
    offset = (0 if cls_token_at_end else 1) + (zero if sequence_a_is_doc else q + 1)
    cls_seg = F.lit(cls_token_segment_id)
    out = (
        df.withColumn(
            "tokens",
            lay(
                F.array(F.lit(cls_token)),
                F.col("query_tokens"),
                F.array(F.lit(sep_token)),
                F.col("sub_tokens"),
                F.array(F.lit(sep_token)),
            ),
        )
        .withColumn(
            "token_to_orig",
            lay(
                F.array(none_int),
                F.array_repeat(none_int, q),
                F.array(none_int),
                F.col("tok_to_orig"),
                F.array(none_int),
            ),
        )
        .withColumn(
            "is_max_context",
            lay(
                F.array(none_flag),
                F.array_repeat(none_flag, q),
                F.array(none_flag),
                F.col("is_max_context"),
                F.array(none_flag),
            ),
        )
        .withColumn("input_mask", F.concat(F.array_repeat(F.lit(on), n), F.array_repeat(F.lit(off), pad)))
        .withColumn(
            "segment_ids",
            F.concat(
                cells(cls_seg, F.lit(1 - b), zero, F.lit(b), one),
                F.array_repeat(F.lit(pad_token_segment_id), pad),
            ),
        )
        .withColumn("p_mask", F.concat(cells(zero, one, one, zero, one), F.array_repeat(one, pad)))
        .withColumn("cls_index", n - 1 if cls_token_at_end else zero)
        .withColumn("passage_offset", offset)
        .withColumn("orig_first", F.get("tok_to_orig", 0))
    )
    if ids is None:
        return out
    cls_id, sep_id, pad_id = (F.lit(i).cast("bigint") for i in ids)
    return out.withColumn(
        "input_ids",
        F.concat(
            lay(F.array(cls_id), F.col("query_ids"), F.array(sep_id), F.col("sub_ids"), F.array(sep_id)),
            F.array_repeat(pad_id, pad),
        ),
    )


def number_features(df: DataFrame, order: Sequence[str], first: int = 1_000_000_000) -> DataFrame:
    """Add ``unique_id``: consecutive numbers in ``order``."""
    return positions(df, [], list(order), "unique_id", first)


def encode_arrays(
    df: DataFrame, key: str, columns: Mapping[str, str], vocab: DataFrame, unk: int, hot: DataFrame | None = None
) -> DataFrame:
    """Add the vocabulary indexes of token arrays; ``columns`` maps array to output.

    ``key`` identifies a row. Documents are encoded before they are cut into
    overlapping windows, so each token is looked up once, and all arrays of a
    row go through the same join. A group collected back is one input row. ``hot``
    are the terms that tokens are full of, if that is known (see ``spread_join``).
    """
    names = list(columns)

    def tagged(n: int) -> Column:
        return F.transform(names[n], lambda t, i: F.struct(F.lit(n).alias("col"), i.alias("pos"), t.alias("term")))

    stacked = F.concat(*[tagged(n) for n in range(len(names))])
    each = df.select(key, F.inline(stacked))
    coded = lookup_join(each, vocab.select("term", "ix"), ["term"], "left", spread=[key, "col", "pos"], hot=hot)
    index = F.coalesce("ix", F.lit(unk).cast("bigint"))
    back = coded.groupBy(key).agg(
        *[
            F.array_sort(
                F.collect_list(F.when(F.col("col") == n, F.struct("pos", index.alias("ix"))))
            ).alias(columns[c])
            for n, c in enumerate(names)
        ]
    )
    empty = F.array().cast("array<bigint>")
    joined = df.join(back, key, "left")
    for out in columns.values():
        joined = joined.withColumn(out, F.coalesce(F.transform(out, lambda s: s["ix"]), empty))
    return joined


def window_answer_span(df: DataFrame) -> DataFrame:
    """Add the answer positions inside a window (start_position, end_position,
    is_impossible), from (tok_start, tok_end, impossible) of the document.

    An answer outside the window, or none, gives the CLS position and impossible.
    """
    start, length = F.col("start"), F.col("length")
    inside = (
        ~F.col("impossible") & (F.col("tok_start") >= start) & (F.col("tok_end") <= start + length - 1)
    )
    shift = F.col("passage_offset") - start
    return df.select(
        "*",
        F.when(inside, F.col("tok_start") + shift).otherwise(F.col("cls_index")).alias("start_position"),
        F.when(inside, F.col("tok_end") + shift).otherwise(F.col("cls_index")).alias("end_position"),
        (~inside).alias("is_impossible"),
    )


def count_examples(df: DataFrame) -> DataFrame:
    """Number of rows: one row (n)."""
    return df.agg(F.count(F.lit(1)).alias("n"))
