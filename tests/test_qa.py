import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.operators import ensemble as N
from lexiloom.operators import qa_eval as E
from lexiloom.operators import qa_prep as Q
from lexiloom.operators import spans as D

SQUAD = "qid string, question string, context string, answers array<struct<text:string,answer_start:int>>, is_impossible boolean"


def test_squad_examples(spark):
    rows = [
        ("1", "q", "x  big red\tdog y", [("red dog", 7)], False),
        ("2", "q", "a b", [("c", 0)], False),
        ("3", "q", "a b", [], True),
    ]
    df = spark.createDataFrame(rows, SQUAD)
    got = {r.qid: r for r in Q.squad_examples(df, True, True).collect()}
    assert set(got) == {"1", "3"}
    assert (got["1"].start_position, got["1"].end_position, got["1"].doc_tokens) == (2, 3, ["x", "big", "red", "dog", "y"])
    assert (got["3"].start_position, got["3"].orig_answer_text) == (-1, "")
    assert tuple(Q.unrecoverable_count(df, True).first()) == (1, 2)
    assert Q.squad_examples(df).where("start_position is null").count() == 3
    with pytest.raises(Exception, match="one answer expected"):
        Q.squad_examples(df, True, False).collect()


def test_augmented_copies(spark):
    rows = [(str(i), "q", "one two three", [("two three", 4)], False) for i in range(4)]
    ex = Q.squad_examples(spark.createDataFrame(rows, SQUAD), True)
    syn = spark.createDataFrame([("two", 1, "two"), ("two", 2, "pair")], "word string, rank int, synonym string")
    got = [(r.qid, r["copy"], r.orig_answer_text) for r in Q.augment_answers(ex, syn, 0.5).collect()]
    assert len(got) == 8
    assert sorted(t for _, c, t in got if c) == ["pair three", "pair three", "two three", "two three"]


def test_nq_examples_move_the_answer_past_markup(spark):
    schema = (
        "example_id bigint, question_text string, document_text string, annotations array<struct<long_answer:"
        "struct<start_token:int,end_token:int>,short_answers:array<struct<start_token:int,end_token:int>>>>"
    )
    doc = "h <p> a <b> c d </b> e f"
    rows = [(1, "q", doc, [((1, 8), [(4, 6)])]), (2, "q", doc, [((1, 8), [])]), (3, "q", doc, [((1, 8), [(7, 8)])])]
    df = Q.with_short_answer(spark.createDataFrame(rows, schema))
    got = {r.qid: r for r in Q.nq_examples(df).collect()}
    assert set(got) == {1, 3}
    assert got[1].doc_tokens == ["a", "c", "d", "e"] and got[1].orig_answer_text == "c d"
    assert (got[3].start_position, got[3].end_position, got[3].orig_answer_text) == (3, 4, "e")


def brute_windows(n, room, stride):
    out, at = [], 0
    while at < n:
        size = min(n - at, room)
        out.append((at, size))
        if at + size == n:
            break
        at += min(size, stride)
    return out


def test_windows_and_max_context_against_brute_force(spark):
    rng = random.Random(1)
    for stride in (1, 3, 7, 20):
        cases = [(i, rng.randint(1, 50), rng.randint(1, 14)) for i in range(60)] + [(99, 10, 4)]
        df = spark.createDataFrame(cases, "id int, n int, room int")
        w = Q.doc_windows(df.select("id", "n", F.col("room").alias("r")), F.col("n"), F.lit(47) - F.col("r"), 50, stride)
        got = {(r.id, r.window): (r.start, r.length, r.is_max_context) for r in Q.max_context(w).collect()}
        want = {}
        for i, n, room in cases:
            spans = brute_windows(n, room, stride)
            score = lambda p, s: min(p - s[0], s[0] + s[1] - 1 - p) + 0.01 * s[1]
            for k, s in enumerate(spans):
                flags = []
                for p in range(s[0], s[0] + s[1]):
                    over = [(score(p, t), -j) for j, t in enumerate(spans) if t[0] <= p < t[0] + t[1]]
                    flags.append(-max(over)[1] == k)
                want[(i, k)] = (*s, flags)
        assert got == want


def test_feature_layouts(spark):
    row = [(1, ["q1", "q2"], ["a", "b", "##c", "d"], [0, 1, 1, 2], ["a", "bc", "d"])]
    df = spark.createDataFrame(
        row,
        "id int, query_tokens array<string>, sub_tokens array<string>, tok_to_orig array<int>, doc_tokens array<string>",
    )
    w = Q.max_context(Q.doc_windows(df, F.size("sub_tokens"), F.size("query_tokens"), 8, 2, Q.feature_cuts(), ["doc_tokens"]))
    first = {r.window: r for r in Q.assemble_features(w, 8).collect()}
    assert first[0].tokens == ["[CLS]", "q1", "q2", "[SEP]", "a", "b", "##c", "[SEP]"]
    assert first[0].segment_ids == [0, 0, 0, 0, 1, 1, 1, 1]
    assert first[0].p_mask == [0, 1, 1, 1, 0, 0, 0, 1]
    assert first[0].token_to_orig == [None] * 4 + [0, 1, 1, None]
    assert first[1].tokens[4:7] == ["##c", "d", "[SEP]"] and first[1].input_mask == [1] * 7 + [0]
    assert (first[1].orig_first, first[1].orig_tokens) == (1, ["bc", "d"])
    last = Q.assemble_features(w, 8, cls_token_at_end=True, sequence_a_is_doc=True, cls_token_segment_id=2).where(
        "window = 0"
    ).first()
    assert last.tokens == ["a", "b", "##c", "[SEP]", "q1", "q2", "[SEP]", "[CLS]"]
    assert last.segment_ids == [0, 0, 0, 0, 1, 1, 1, 2] and last.cls_index == 7 and last.passage_offset == 0


def test_answer_in_window_and_tightening(spark):
    df = spark.createDataFrame(
        [(1, 5, 6, False, 4, 5, 0, 10), (2, 2, 6, False, 4, 5, 0, 10), (3, -1, -1, True, 4, 5, 0, 10)],
        "id int, tok_start int, tok_end int, impossible boolean, start int, length int, cls_index int, passage_offset int",
    )
    got = {r.id: (r.start_position, r.end_position, r.is_impossible) for r in Q.window_answer_span(df).collect()}
    assert got == {1: (11, 12, False), 2: (0, 0, True), 3: (0, 0, True)}
    toks = spark.createDataFrame([(["(", "1895", "-", "1943", ")"], ["1895"])], "t array<string>, a array<string>")
    hit = toks.select(Q.tighten_answer_span(F.col("t"), F.lit(0), F.lit(4), F.col("a")).alias("s")).first()["s"]
    assert tuple(hit) == (1, 1)
    miss = toks.select(Q.tighten_answer_span(F.col("t"), F.lit(2), F.lit(4), F.col("a")).alias("s")).first()["s"]
    assert tuple(miss) == (2, 4)


def test_encode_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"], ["z"]), (2, [], ["a"])], "id int, x array<string>, y array<string>")
    vocab = spark.createDataFrame([("a", 5), ("b", 6)], "term string, ix bigint")
    got = {r.id: (r.xi, r.yi) for r in Q.encode_arrays(df, "id", {"x": "xi", "y": "yi"}, vocab, 0).collect()}
    assert got == {1: ([5, 6, 5], [0]), 2: ([], [5])}


def test_f1_and_exact(spark):
    pairs = spark.createDataFrame([("The cat sat", "a cat"), ("a", "the"), ("x", "y")], "p string, g string")
    got = [
        tuple(r)
        for r in pairs.select(
            E.exact_match(F.col("p"), F.col("g")),
            E.token_f1(F.col("p"), F.col("g")),
            E.token_f1(F.col("p"), F.col("g"), True),
        ).collect()
    ]
    assert got[0][0] == 0 and math.isclose(got[0][1], 2 / 3)
    assert got[1] == (1.0, 0.0, 1.0) and got[2] == (0.0, 0.0, 0.0)


def test_evaluate(spark):
    qs = spark.createDataFrame([(1, ["x y", "x"]), (2, ["z"]), (3, []), (4, ["the"])], "qid int, answers array<string>")
    ps = spark.createDataFrame([(1, "x"), (3, ""), (4, "")], "qid int, text string")
    v1 = E.evaluate_v1(qs, ps).first()
    assert (v1.total, v1.unanswered, v1.exact_match) == (4, 1, 50.0)
    v2 = E.evaluate_v2(qs, ps).first()
    assert (v2.total, v2.missing, v2.exact, v2.HasAns_total, v2.NoAns_total) == (3, 1, 100.0, 2, 1)
    na = spark.createDataFrame([(1, 0.9), (3, 0.9), (4, 0.1)], "qid int, na_prob double")
    cut = E.evaluate_v2(qs, ps, na, 0.5).first()
    assert (cut.HasAns_exact, cut.NoAns_exact) == (50.0, 100.0)


def na_table(spark, rows):
    return spark.createDataFrame(rows, "qid int, has_answer boolean, answered boolean, na_prob double, score double")


def test_threshold_and_precision_fixture(spark):
    df = na_table(spark, [(1, True, True, 0.1, 1.0), (2, False, True, 0.9, 0.0)])
    best = E.best_threshold(df).first()
    assert (best.best, best.threshold, best.has_answer_mean) == (100.0, 0.1, 1.0)
    assert E.average_precision(df).first()["ap"] == 100.0


def test_threshold_against_a_walk(spark):
    rng = random.Random(5)
    rows = [
        (i, rng.random() < 0.6, rng.random() < 0.7, round(rng.random(), 1), round(rng.random(), 3)) for i in range(200)
    ]
    df = na_table(spark, rows)
    start = run = top = sum(not r[1] for r in rows)
    where = 0.0
    for r in sorted(rows, key=lambda r: (r[3], r[0])):
        run += r[4] if r[1] else (-1 if r[2] else 0)
        if round(run, 9) > round(top, 9):
            top, where = run, r[3]
    assert start <= top
    best = E.best_threshold(df).first()
    assert math.isclose(best.best, 100 * top / 200, abs_tol=1e-6) and best.threshold == where
    pos, area, tp, seen, last = sum(r[1] for r in rows), 0.0, 0.0, 0, 0.0
    order = sorted(rows, key=lambda r: r[3])
    for i, r in enumerate(order):
        tp += r[4] if r[1] else 0
        seen += 1
        if i == len(order) - 1 or order[i + 1][3] != r[3]:
            area += tp / seen * (tp / pos - last)
            last = tp / pos
    assert math.isclose(E.average_precision(df).first()["ap"], 100 * area, abs_tol=1e-9)


def test_histogram_edges(spark):
    values = [i / 100 for i in range(101)] + [i * 0.05 for i in range(20)]
    df = na_table(spark, [(i, True, True, p, 1.0) for i, p in enumerate(values)])
    got = {r.bin: round(r.share * len(values)) for r in E.na_prob_histogram(df).collect()}
    want, _ = np.histogram(values, bins=20, range=(0.0, 1.0))
    assert [got.get(i, 0) for i in range(20)] == want.tolist()


def feature_rows(spark):
    toks = [["[CLS]", "q", "[SEP]", "a", "b", "##c", "[SEP]"], ["[CLS]", "q", "[SEP]", "b", "##c", "d", "[SEP]"]]
    orig = [[None] * 3 + [0, 1, 1, None], [None] * 3 + [1, 1, 2, None]]
    best = [[None] * 3 + [True, True, False, None], [None] * 3 + [False, True, True, None]]
    words = [["A", "Bc"], ["Bc", "D."]]
    rows = [(i, 7, i, toks[i], orig[i], best[i], words[i], i) for i in range(2)]
    return spark.createDataFrame(
        rows,
        "unique_id bigint, qid int, feature_index int, tokens array<string>, token_to_orig array<int>, "
        "is_max_context array<boolean>, orig_tokens array<string>, orig_first int",
    )


def test_spans_end_to_end(spark):
    features = feature_rows(spark)
    results = spark.createDataFrame(
        [
            (0, [0.5, 9.0, 0.0, 3.0, 2.0, 8.0, 0.0], [0.1, 0.0, 0.0, 1.0, 0.5, 4.0, 0.0]),
            (1, [0.2, 0.0, 0.0, 9.0, 1.0, 2.5, 0.0], [0.1, 0.0, 0.0, 0.0, 1.0, 2.0, 9.0]),
        ],
        "unique_id bigint, start_logits array<double>, end_logits array<double>",
    )
    cands = D.span_text(D.span_candidates(results, features))
    assert {r.text for r in cands.collect()} >= {"A Bc", "A", "Bc"}
    assert all(3 <= r.start <= r.end <= 5 for r in cands.collect())
    questions = spark.createDataFrame([(7,), (8,)], "qid int")
    nbest = D.nbest_spans(cands, 3, questions).orderBy("qid", "rank").collect()
    assert nbest[0].text == "A Bc" and nbest[-1].text == "empty" and nbest[-1].probability == 1.0
    assert math.isclose(sum(r.probability for r in nbest if r.qid == 7), 1.0)
    nulls = D.null_scores(results, features)
    assert math.isclose(nulls.first()["score_null"], 0.3)
    with_null = D.nbest_spans(cands, 3, nulls=nulls)
    assert [r.text for r in with_null.orderBy("rank").collect()][-1] == ""
    ans = D.best_answer(with_null, nulls)
    assert ans.first()["text"] == "A Bc"
    assert D.best_answer(with_null, nulls, -100.0).first()["text"] == ""


def test_a_lone_null_gets_company(spark):
    cands = D.span_text(D.span_candidates(
        spark.createDataFrame([], "unique_id bigint, start_logits array<double>, end_logits array<double>"),
        feature_rows(spark),
    ))
    nulls = spark.createDataFrame([(7, 1.0, 0.5, 0.5)], "qid int, score_null double, start_logit double, end_logit double")
    got = [(r.rank, r.text) for r in D.nbest_spans(cands, 3, nulls=nulls).orderBy("rank").collect()]
    assert got == [(1, "empty"), (2, "")]
    assert D.best_answer(D.nbest_spans(cands, 3, nulls=nulls), nulls).first()["text"] == ""


def test_null_at_threshold_fixture(spark):
    nbest = spark.createDataFrame(
        [(1, 1, "x", 0.25, 0.25), (1, 2, "", 0.5, 0.5)],
        "qid int, rank int, text string, start_logit double, end_logit double",
    )
    nulls = spark.createDataFrame([(1, 1.0)], "qid int, score_null double")
    r = D.best_answer(nbest, nulls).first()
    assert (r.text, r.score_diff) == ("", 0.5)


def test_softmax(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 0.0), (2, 1000.0), (2, 0.0)], "k int, s double")
    got = sorted(r.probability for r in D.softmax_within(df, ["k"], "s", spread=["s"]).collect())
    assert got == [0.0, 0.5, 0.5, 1.0]


def test_ensembles(spark):
    w = spark.createDataFrame([("m1", 1.0), ("m2", 1.0)], "model string, weight double")
    n = spark.createDataFrame(
        [(1, "m1", "x", 0.1), (1, "m1", "y", 0.9), (1, "m2", "x", 0.1), (1, "m9", "y", 0.9)],
        "qid int, model string, text string, probability double",
    )
    assert N.ensemble_vote(n, w).first()["text"] == "x"
    assert N.ensemble_probability_sum(n, w).first()["text"] == "y"
    assert N.unknown_models(n, w).first()["n"] == 1
    heavy = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 1.0)], "model string, weight double")
    p = spark.createDataFrame([(1, "a", "A"), (1, "b", "B"), (1, "c", "C")], "qid int, model string, text string")
    assert N.ensemble_stochastic(p, heavy, 1.0).first()["text"] == "A"
    assert N.ensemble_stochastic(p, heavy, 0.0).first()["text"] == "C"
    assert N.ensemble_stochastic(p, heavy).collect() == N.ensemble_stochastic(p.repartition(7), heavy).collect()


def test_softmax_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 0.0), (None, 2, 0.0), (1, 3, 5.0)], "k int, id int, s double")
    got = {r.id: r.probability for r in D.softmax_within(df, ["k"], "s", spread=["id"]).collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 1.0}


def test_question_is_cut_by_the_library(spark):
    row = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(90)), lambda i: i.cast("string")).alias("q"))
    assert row.select(F.size(Q.query_tokens(F.col("q"))), F.size(Q.query_tokens(F.col("q"), 5))).first()[:] == (64, 5)


def test_curve_points_give_the_area(spark):
    rows = [(0.1, True, 1.0), (0.2, True, 0.5), (0.2, False, 0.0), (0.9, True, 0.0), (None, True, 0.0)]
    scores = spark.createDataFrame(rows, "na_prob double, has_answer boolean, score double")
    points = sorted(E.precision_recall_curve(scores).collect(), key=lambda r: r.na_prob)
    assert [(r.na_prob, r.precision, r.recall) for r in points] == [(0.1, 1.0, 0.25), (0.2, 0.5, 0.375), (0.9, 0.375, 0.375)]
    area, before = 0.0, 0.0
    for r in points:
        area, before = area + r.precision * (r.recall - before), r.recall
    assert abs(E.average_precision(scores).first().ap - 100 * area) < 1e-9


@pytest.mark.parametrize("border", [0, 5, 6, 7, 10**6])
@pytest.mark.parametrize("empty_agrees", [False, True])
def test_f1_of_long_texts_equals_the_row_wise(spark, border, empty_agrees):
    rng = random.Random(border)
    text = lambda: " ".join(rng.choice(["The", "cat,", "cat", "dog", "a", "x-y", "ÉCOLE"]) for _ in range(rng.randint(0, 6)))
    rows = [(i, i % 7 if i % 5 else None, text(), text()) for i in range(120)] + [(200, 1, None, "cat"), (201, 1, "cat", None), (202, 1, "", "")]
    df = spark.createDataFrame(rows, "id int, k int, pred string, gold string")
    want = {r.id: r.f1 for r in df.select("id", E.token_f1(F.col("pred"), F.col("gold"), empty_agrees).alias("f1")).collect()}
    got = E.token_f1_rows(df, ["id", "k"], empty_agrees=empty_agrees, long_tokens=border).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.id in (200, 201):
            assert r.f1 is None
        else:
            assert abs(r.f1 - want[r.id]) < 1e-12


def test_spans_decoded_from_the_source(spark):
    """Pieces, windows that overlap, and ranges that share a text."""
    source = ["The", "Unaffable", "Man,", "the", "unaffable", "man,", "Ürgh"]
    pieces = [("the", 0), ("una", 1), ("##ff", 1), ("##able", 1), ("man", 2), (",", 2), ("the", 3), ("una", 4), ("##ffable", 4), ("man", 5), (",", 5), ("urgh", 6)]
    rows = []
    for lo in (0, 3, 6):
        held = pieces[lo : lo + 7]
        rows.append((f"u{lo}", 1, lo // 3, ["[CLS]"] + [t for t, _ in held], [None] + [o for _, o in held], [False] + [True] * len(held)))
    features = spark.createDataFrame(rows, "unique_id string, qid int, feature_index int, tokens array<string>, token_to_orig array<int>, is_max_context array<boolean>")
    rng = random.Random(1)
    logits = spark.createDataFrame([(r[0], [rng.random() for _ in r[3]], [rng.random() for _ in r[3]]) for r in rows], "unique_id string, start_logits array<double>, end_logits array<double>")
    sources = spark.createDataFrame([(1, source)], "qid int, orig_tokens array<string>")
    cands = D.span_candidates(logits, features, n=5)
    # The window-wise way, with the source cut per window.
    cut = features.select("unique_id", F.lit(0).alias("orig_first"))
    direct = D.span_text(cands.join(cut, "unique_id").crossJoin(sources.select("orig_tokens")))
    want = {(r["rank"], r.text, r.start_logit, r.end_logit) for r in D.nbest_spans(direct, 8).collect()}
    got = {(r["rank"], r.text, r.start_logit, r.end_logit) for r in D.nbest_spans(D.decode_spans(D.located_spans(cands), sources), 8).collect()}
    assert got == want and len(got) > 4


def test_candidates_of_rows_that_carry_their_scores(spark):
    results = spark.createDataFrame([("a", [0.0, 3.0, 1.0, 2.0], [0.0, 1.0, 2.0, 3.0]), ("b", [0.0, 1.0], [0.0, 4.0])], "unique_id string, start_logits array<double>, end_logits array<double>")
    features = spark.createDataFrame(
        [("a", 1, 0, ["[CLS]", "x", "y", "x"], [None, 0, 1, 2], [False, True, True, True]), ("b", 1, 1, ["[CLS]", "x"], [None, 2], [False, True])],
        "unique_id string, qid int, feature_index int, tokens array<string>, token_to_orig array<int>, is_max_context array<boolean>",
    )
    want = D.span_candidates(results, features)
    got = D.span_candidates(None, features.join(results, "unique_id"))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    cands = D.located_spans(got)
    sources = spark.createDataFrame([(1, ["x", "y", "x"])], "qid int, orig_tokens array<string>")
    hot = lambda fan: spark.createDataFrame([(1, fan)], "qid int, __fan int").where("__fan > 1")
    texts = [sorted(map(str, D.decode_spans(cands, sources, hot=h).collect())) for h in (None, hot(1), hot(3))]
    assert texts[0] == texts[1] == texts[2] and len(texts[0]) > 3


def test_equal_texts_project_to_the_source(spark):
    from lexiloom.functions.text import project_to_source_text

    rows = [("a-b c", "a-b c"), (" a b ", " a b "), ("É x", "É x"), ("", ""), (None, "x"), ("a b", "A b"), ("- c", "a-c c")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "p string, o string, i int").repartition(2)
    got = [r.t for r in df.orderBy("i").select(project_to_source_text(F.col("p"), F.col("o")).alias("t")).collect()]
    assert got == ["a-b c", " a b ", "É x", "", "x", "A b", "-c"]


def test_nbest_texts_deals_documents_once(spark, tmp_path):
    from lexiloom.plans.span_queries import _nbest_texts

    words = " ".join(f"w{i * 7 % 50}" for i in range(90))
    rows = [(1, words), (1, words[:150]), (2, "a b c"), (None, "x y"), (3, ""), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = _nbest_texts(spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    keys = {line.split("Exchange hashpartitioning(")[1].split("#")[0] for line in plan.split("\n") if "Exchange hashpartitioning(" in line}
    assert keys == {"doc_id"}
    got = out.groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {1: 20, 2: 3}


def test_subtoken_maps_without_adding_up_sizes(spark):
    """The maps of tokens with and without pieces, on texts of any length."""
    rng = random.Random(4)
    docs = [[rng.choice(["a", "bcdefg", "-", "hi"]) for _ in range(n)] for n in (0, 1, 2, 63, 64, 65, 300)]
    docs += [[w for w in d if w != "-"] for d in docs] + [["-"], ["-", "a", "-", "-", "bcdefg"]]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, toks array<string>")
    cut = lambda t: F.when(t == "-", F.array().cast("array<string>")).when(F.length(t) > 4, F.array(F.substring(t, 1, 4), t)).otherwise(F.array(t))
    got = {r.id: r.m for r in df.select("id", Q.project_subtoken_index(F.col("toks"), cut).alias("m")).collect()}
    for i, d in enumerate(docs):
        pieces = [[] if t == "-" else [t[:4], t] if len(t) > 4 else [t] for t in d]
        assert got[i].sub_tokens == sum(pieces, [])
        assert got[i].tok_to_orig == [k for k, p in enumerate(pieces) for _ in p]
        assert got[i].orig_to_tok == [sum(map(len, pieces[:k])) for k in range(len(d))]


def test_f1_rows_against_counters(spark):
    """Bags of words of rows of any length, with repeats and marks, and null and empty texts."""
    rng = random.Random(6)
    some = lambda n: " ".join(rng.choice(["The", "cat,", "Ärm", "a", "x\u0001", "1", "　", "..."]) for _ in range(n))
    rows = [(i, some(rng.randrange(40)), some(rng.randrange(40))) for i in range(60)] + [(90, None, "x"), (91, "x", None), (92, "", "x"), (93, "the", "a")]
    df = spark.createDataFrame(rows, "id int, pred string, gold string")
    want = {r.id: r.f1 for r in df.select("id", E.token_f1(F.col("pred"), F.col("gold")).alias("f1")).collect()}
    for border in (1, 20, 1000):
        got = E.token_f1_rows(df, ["id"], long_tokens=border)
        assert {r.id: r.f1 for r in got.collect()} == pytest.approx(want)
    assert "array_intersect" not in got._jdf.queryExecution().optimizedPlan().toString()  # no bag is sorted and numbered in SQL


def test_augmented_copies_leave_documents_behind(spark):
    """Only the wanted columns are numbered; the rows are those of all columns."""
    docs = [(i, [f"w{i}", "b", "c", "d"], "b c", 1, 2, i % 5 == 0) for i in range(30)]
    ex = spark.createDataFrame(docs, "qid int, doc_tokens array<string>, orig_answer_text string, start_position int, end_position int, is_impossible boolean")
    synonyms = spark.createDataFrame([("b", 1, "b"), ("b", 2, "B")], "word string, rank int, synonym string")
    whole = Q.augment_answers(ex, synonyms)
    few = Q.augment_answers(ex, synonyms, columns=["qid", "orig_answer_text"])
    assert whole.columns == [*ex.columns, "copy"] and few.columns == ["qid", "orig_answer_text", "copy"]
    assert sorted(whole.select(few.columns).collect()) == sorted(few.collect()) and few.count() == 54
    assert few.where("copy = 1 AND orig_answer_text = 'B c'").count() == 17  # the first 0.7 of 24


def test_index_maps_add_up_no_sizes(spark, monkeypatch):
    """Where every token has a piece, the maps need no running sum."""
    monkeypatch.setattr(Q, "running_sum", lambda v: F.raise_error(F.lit("added up")).cast("array<int>"))
    df = spark.createDataFrame([(["ab", "bcdefg", "c"],)], "toks array<string>")
    cut = lambda t: F.when(F.length(t) > 4, F.array(F.substring(t, 1, 4), t)).otherwise(F.array(t))
    assert df.select(Q.project_subtoken_index(F.col("toks"), cut).alias("m")).first().m.orig_to_tok == [0, 1, 3]


def test_encode_features_reads_documents_once(spark):
    """What is asked for reads the stored sub-tokens: the documents are not cut anew."""
    from lexiloom.plans.qa_queries import _encode

    files = _encode(spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not any("documents.parquet" in f for f in files)


def test_encode_arrays_with_known_hot_terms(spark, monkeypatch):
    from lexiloom.operators import skew

    monkeypatch.setattr(skew, "MAX_LOOKUP_ROWS", 0)  # no broadcast
    monkeypatch.setattr(skew, "hot_keys", lambda *a: 1 / 0)  # the tokens are not read for their hot terms
    df = spark.createDataFrame([(1, ["a", "b", "a"], ["z"]), (2, [], ["a"])], "id int, x array<string>, y array<string>")
    vocab = spark.createDataFrame([("a", 5), ("b", 6)], "term string, ix bigint")
    hot = spark.createDataFrame([("a", 3), ("z", 2)], "term string, __fan int")
    got = {r.id: (r.xi, r.yi) for r in Q.encode_arrays(df, "id", {"x": "xi", "y": "yi"}, vocab, 0, hot=hot).collect()}
    assert got == {1: ([5, 6, 5], [0]), 2: ([], [5])}
