import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.functions import vectors as FV
from lexiloom.operators import bitext as B
from lexiloom.operators import score as H
from lexiloom.operators import nearest
from lexiloom.operators import vectors as V


def table(spark, vecs):
    return spark.createDataFrame([(w, [float(x) for x in v]) for w, v in vecs.items()], "word string, vec array<double>")


@pytest.fixture(scope="module")
def random_vectors():
    rng = np.random.default_rng(0)
    return {f"w{i}": rng.normal(size=6) for i in range(40)}


def test_arithmetic(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<double>, b array<double>")
    r = df.select(FV.l2_normalize(F.col("a")), FV.cosine(F.col("a"), F.col("b")), FV.pcos(F.col("a"), F.col("b"))).first()
    assert math.isclose(r[0][0], 3 / math.sqrt(25 + 1e-6)) and math.isclose(r[1], 0.96) and math.isclose(r[2], 0.98)


@pytest.mark.parametrize("block", [7, 8192])
def test_most_similar_against_all_pairs(spark, random_vectors, block):
    t = table(spark, random_vectors)
    got = {}
    for r in V.most_similar(t, t, 3, rows_per_block=block).collect():
        got.setdefault(r.word, {})[r.rank] = (r.other, r.sim)
    names = list(random_vectors)
    m = np.stack([random_vectors[n] / np.linalg.norm(random_vectors[n]) for n in names])
    sims = m @ m.T
    for i, w in enumerate(names):
        order = sorted((j for j in range(len(names)) if j != i), key=lambda j: -sims[i, j])[:3]
        assert [got[w][k + 1][0] for k in range(3)] == [names[j] for j in order]
        assert math.isclose(got[w][1][1], sims[i, order[0]], abs_tol=1e-9)


def test_buckets_find_most_of_the_nearest(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8))
    vecs = {f"w{i:03d}": centres[i % 20] + 0.3 * rng.normal(size=8) for i in range(300)}
    t = table(spark, vecs)
    exact = {(r.word, r.other): r.sim for r in V.most_similar(t, t, 5).collect()}
    got = V.similar_in_buckets(t, t, 8, 5, tables=16, bits=5, seed=3).collect()
    found = {(r.word, r.other): r.sim for r in got}
    assert len(set(exact) & set(found)) >= 0.9 * len(exact)
    assert all(math.isclose(found[p], exact[p], abs_tol=1e-9) for p in set(exact) & set(found))
    by_word = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_word.setdefault(r.word, []).append(r.sim)
    assert all(sims == sorted(sims, reverse=True) for sims in by_word.values())
    assert {(r.word, r.other) for r in V.similar_in_buckets(t, t, 8, 1, bits=5, exclude_self=False).collect()} == {(w, w) for w in vecs}


def test_default_buckets_on_the_embeddings(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(F.col("vec_id").alias("word"), F.col("embedding").alias("vec"))
    exact = {(r.word, r.other) for r in V.most_similar(t, t, 10).collect()}
    got = {(r.word, r.other) for r in V.similar_in_buckets(t, t, V.vector_size(t), 10).collect()}
    assert len(got) == len(exact) and len(got & exact) >= 0.9 * len(exact)


def test_words_of_empty_buckets_are_searched_exactly(spark, random_vectors):
    t = table(spark, random_vectors)
    exact = sorted((r.word, r["rank"], r.other, r.sim) for r in V.most_similar(t, t, 5).collect())
    # One table of 30 planes: hardly any two words share a bucket.
    assert sorted((r.word, r["rank"], r.other, r.sim) for r in V.similar_in_buckets(t, t, 6, 5, tables=1, bits=30).collect()) == exact


def found_in(df):
    return {(r.word, r["rank"]): (r.other, r.sim) for r in df.collect()}


def test_inverted_file_on_the_embeddings(spark):
    """Recall at the defaults on vectors without structure, with few exact comparisons."""
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("word"), F.col("embedding").alias("vec"))
    queries = t.where(F.col("word") % 10 == 0)
    exact = V.most_similar(queries, t, 10).collect()
    got = nearest.nearest_in_cells(queries, t, 10).collect()
    pairs = {(r.word, r.other): r.sim for r in exact}
    shared = [(r.word, r.other) for r in got if (r.word, r.other) in pairs]
    assert len(got) == len(exact) and len(shared) >= 0.9 * len(exact)
    assert all(math.isclose(r.sim, pairs[r.word, r.other], abs_tol=1e-9) for r in got if (r.word, r.other) in pairs)
    assert 3 * 10 <= 0.1 * t.count()  # rerank * k exact comparisons per query word


@pytest.mark.parametrize("block", [7, 8192])
def test_inverted_file_on_clusters(spark, block):
    """Few cells are enough where vectors are clustered; all of them give the exact answer."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    vecs = {f"w{i:03d}": centres[min(i % 18, 11)] + 0.2 * rng.normal(size=8) for i in range(240)}
    vecs["zero"] = np.zeros(8)
    t = table(spark, vecs)
    exact = found_in(V.most_similar(t, t, 5))
    every = found_in(nearest.nearest_in_cells(t, t, 5, cells=10, probe=1.0, rerank=50, rows_per_block=block))
    assert {k: v[0] for k, v in every.items() if k[0] != "zero"} == {k: v[0] for k, v in exact.items() if k[0] != "zero"}
    few = found_in(nearest.nearest_in_cells(t, t, 5, cells=24, probe=0.2, rows_per_block=block))
    assert set(few) == set(exact) and sum(few[k][0] == exact[k][0] for k in exact) >= 0.9 * len(exact)


def test_inverted_file_with_awkward_tables(spark, random_vectors):
    t = table(spark, random_vectors)
    none = t.where("false")
    assert nearest.nearest_in_cells(t, none, 3).count() == 0 and nearest.nearest_in_cells(none, t, 3).count() == 0
    holes = t.unionByName(t.limit(1).select(F.lit("hole").alias("word"), F.lit(None).cast(t.schema["vec"].dataType).alias("vec")))
    # One tiny cell per query: too short a list is completed by the exact search.
    exact = found_in(V.most_similar(t, t, 4))
    got = found_in(nearest.nearest_in_cells(holes, holes, 4, cells=len(random_vectors), probe=0.001))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in exact.items()}
    own = found_in(nearest.nearest_in_cells(t, t, 1, exclude_self=False))
    assert {k[0]: v[0] for k, v in own.items()} == {w: w for w in random_vectors}


def brute_retrofit(vecs, edges, iters, alpha, beta, published=False):
    cur = dict(vecs)
    for _ in range(iters):
        new = dict(cur)
        for w in vecs:
            ns = {n for h, n in edges if h == w and n in vecs}
            if ns:
                low = alpha + len(ns) * beta if published else len(ns) * (alpha + beta)
                new[w] = (alpha * vecs[w] + beta * sum(cur[n] for n in ns)) / low
        cur = new
    return cur


@pytest.mark.parametrize("published", [False, True])
def test_retrofit(spark, random_vectors, published):
    names = list(random_vectors)
    edges = [(names[i], names[0]) for i in range(1, 30)] + [(names[i], names[i + 1]) for i in range(20)]
    edges += [(names[0], "unknown"), edges[0]]
    e = spark.createDataFrame(edges, "head string, neighbour string")
    got = V.retrofit(table(spark, random_vectors), e, 5, published=published, cut_every=2, rows_per_task=4).collect()
    want = brute_retrofit(random_vectors, edges, 5, 1.0, 2.19, published)
    assert len(got) == len(names)
    for r in got:
        assert np.allclose(r.vec, want[r.word])


def test_retrofit_fixture(spark):
    t = table(spark, {"x": [1, 0], "y": [0, 1]})
    e = spark.createDataFrame([("x", "y")], "head string, neighbour string")
    got = {r.word: r.vec for r in V.retrofit(t, e, 1, 1.0, 1.0).collect()}
    assert got == {"x": [0.5, 0.5], "y": [0.0, 1.0]}


def test_substitutes_and_context(spark, random_vectors):
    t = table(spark, random_vectors)
    qs = spark.createDataFrame(
        [(1, 1, ["w3", "w5", "w7", "w7", "zz"]), (2, 0, ["w5"]), (3, 0, ["zz", "w1"])],
        "qid int, target_idx int, tokens array<string>",
    )
    plain = {r.qid: r.guesses for r in V.substitutes(qs, t, 4).collect()}
    assert len(plain[1]) == 4 and plain[1] == plain[2] and plain[3] == []
    ctx = {r.qid: r.guesses for r in V.substitutes(qs, t, 4, context=True).collect()}
    cos = lambda a, b: float(
        random_vectors[a] @ random_vectors[b] / np.linalg.norm(random_vectors[a]) / np.linalg.norm(random_vectors[b])
    )
    fit = lambda s: (cos(s, "w5") * 2 + cos(s, "w3") + cos(s, "w7")) / 4
    assert ctx[1] == sorted(plain[1], key=lambda s: -fit(s)) and ctx[2] == [] and ctx[3] == []


def test_hits(spark):
    gold = spark.createDataFrame([(1, ["team"]), (2, ["x"])], "qid int, gold array<string>")
    pred = spark.createDataFrame([(1, ["side", "team"]), (2, ["y", "x"])], "qid int, guesses array<string>")
    assert V.hit_precision(gold, pred).first()["precision"] == 1.0
    assert V.hit_precision(gold, pred, 1).first()["precision"] == 0.0


def text(spark, rows):
    return spark.createDataFrame(rows, "line_no int, text string")


def test_bleu(spark):
    ref = text(spark, [(0, "the cat sat on the mat"), (1, "a b c d e")])
    same = B.corpus_bleu(ref, ref).first()
    assert math.isclose(same.bleu, 100.0)
    hyp = text(spark, [(0, "The cat the cat on mat"), (1, "a x c y e")])
    got = B.corpus_bleu(ref, hyp).first()
    # 1-grams 5 + 3 of 11; 2-grams 1 of 9; no 3- or 4-grams: smoothed by 2 and 4.
    p = [100 * 8 / 11, 100 * 1 / 9, 100 / (2 * 7), 100 / (4 * 5)]
    assert [round(x, 9) for x in (got.p1, got.p2, got.p3, got.p4)] == [round(x, 9) for x in p]
    assert math.isclose(got.bleu, math.exp(sum(map(math.log, p)) / 4))
    short = B.corpus_bleu(ref, text(spark, [(0, "the cat sat on"), (1, "a b c d")])).first()
    assert math.isclose(short.bleu, 100 * math.exp(1 - 11 / 8))


def test_bitext_filters(spark):
    df = spark.createDataFrame([(0, ["a"], ["b"]), (1, ["a"] * 3, ["b"]), (2, [], ["b"])], "pair_id bigint, src array<string>, tgt array<string>")
    assert {r.pair_id for r in B.filter_bitext(df, 2).collect()} == {0, 2}
    assert {r.pair_id for r in B.filter_bitext(df, 2, 1).collect()} == {0}
    with pytest.raises(ValueError, match="columns not found"):
        B.filter_bitext(df.drop("tgt"))
    assert {r.pair_id: r.bucket for r in B.length_buckets(df, 2).collect()} == {2: 0, 0: 0, 1: 1}


def tags_with_blanks(spark):
    rows = [("dev", 0, "B-X"), ("dev", 1, ""), ("dev", 2, "I-X")]
    return spark.createDataFrame(rows, "testset string, line_no int, text string")


def test_score_runs(spark):
    gold = spark.createDataFrame([("dev", 0, "a b"), ("dev", 1, ""), ("dev", 2, "c d")], "testset string, line_no int, text string")
    runs = spark.createDataFrame(
        [("r1", "dev", 0, "a b"), ("r1", "dev", 1, "c d"), ("r1", "dev", 2, "extra"), ("r2", "dev", 0, "a b")],
        "run string, testset string, line_no int, text string",
    )
    names = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "run string")
    # lines "a b", "", "c d" against "a b", "c d", "extra": tp 2, fp 3, fn 2
    got = {r.run: round(r.score, 9) for r in H.score_runs(gold, runs, names, "segmentation").collect()}
    assert got == {"r1": round(4 / 9, 9), "r2": 0.0, "r3": 0.0}
    got = {r.run: r.score for r in H.score_runs(gold, runs, names, "segmentation", check_length=False).collect()}
    assert got["r2"] == 1.0 and got["r3"] == 0.0
    blank = runs.withColumn("text", F.when(F.col("line_no") == 1, "x").when(F.col("line_no") == 2, "c d").otherwise(F.col("text")))
    got = {r.run: round(r.score, 9) for r in H.score_runs(gold, blank, names, "segmentation").collect()}
    assert got["r1"] == round(8 / 9, 9)
    spaced = tags_with_blanks(spark)
    assert H.score_runs(spaced, spaced.where("text <> ''").withColumn("run", F.lit("r1")), names.limit(1), "chunks").first()["score"] == 100.0
    tags = spark.createDataFrame([("dev", 0, "B-X"), ("dev", 1, "O")], "testset string, line_no int, text string")
    preds = tags.select(F.lit("r1").alias("run"), "*")
    assert H.score_runs(tags, preds, names.limit(1), "chunks").first()["score"] == 100.0
    subs = spark.createDataFrame([("dev", 0, "side.n\tteam")], "testset string, line_no int, text string")
    guess = spark.createDataFrame([("r1", "dev", 0, "x team")], "run string, testset string, line_no int, text string")
    assert H.score_runs(subs, guess, names.limit(1), "hits").first()["score"] == 100.0


def test_bleu_of_repeated_and_empty_lines(spark, tmp_path):
    """Texts of a line that has several meet each other; null texts and keys and empty lines count for nothing."""
    rng = random.Random(5)
    some = lambda: " ".join(rng.choice("abÄc") for _ in range(rng.randrange(0, 9)))
    rows = [[(i % 3, i % 20, some()) for i in range(60)] + [(0, 1, some()), (0, 1, None), (None, 2, "a b"), (1, None, "a b"), (7, 7, " 　")] for _ in "rh"]
    rows[1].append((2, 5, some()))
    ref, hyp = (spark.createDataFrame(r, "run int, line_no int, text string") for r in rows)
    want = {}
    for run, line, r in rows[0]:
        for other, at, h in rows[1]:
            if None not in (run, line, r, h) and (run, line) == (other, at):
                for n in range(1, 5):
                    for side, t in enumerate((r, h)):
                        words = t.lower().split()
                        for i in range(len(words) - n + 1):
                            want.setdefault((run, n), {}).setdefault((line, *words[i : i + n]), [0, 0])[side] += 1
    got = {r.run: r for r in B.corpus_bleu(ref, hyp, by=["run"]).collect()}
    assert set(got) == {0, 1, 2}
    for run, r in got.items():
        assert r.ref_len == sum(a for a, _ in want[run, 1].values()) and r.hyp_len == sum(b for _, b in want[run, 1].values())
        for n in range(1, 5):
            shared, all_of = sum(min(c) for c in want[run, n].values()), sum(b for _, b in want[run, n].values())
            assert shared == 0 or math.isclose(r[f"p{n}"], 100 * shared / all_of)
    plan = B.corpus_bleu(ref, hyp)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # n-grams do not become rows


def test_candidates_are_searched_once(spark):
    """Reranking reads its candidates three times, but what they come from runs once."""
    vectors = spark.createDataFrame([(w, [float(i), 1.0, float(i % 2)]) for i, w in enumerate("abcdef")], "word string, vec array<float>")
    queries = spark.createDataFrame([(1, 0, ["a", "b"]), (2, 1, ["c", "d"])], "qid int, target_idx int, tokens array<string>")
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(len(b))
            yield b

    cands = spark.createDataFrame([(1, "c"), (1, "d"), (2, "a")], "qid int, other string").coalesce(1).mapInPandas(count, "qid int, other string")
    assert len(V.rerank_in_context(cands, queries, vectors).collect()) == 3
    assert ran.value == 3


def test_floors_leave_no_neighbour_out():
    """Any size, ties and excluded words: the floor is reached by the k largest."""
    rng = np.random.default_rng(2)
    for n in (1, 5, 19, 20, 64, 100, 1000):
        sims = np.round(rng.normal(size=(7, n)), 1)
        sims[:, rng.integers(n)] = -np.inf
        for k in (1, 3, 10):
            at = max(0, n - k)
            assert (V._floors(sims, k) <= np.partition(sims, at, axis=1)[:, at]).all()
