import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.operators import long_lines
from lexiloom.operators import ngrams as N
from lexiloom.operators import segment as S
from lexiloom.operators import skew
from lexiloom.operators.membership import membership
from lexiloom.operators.ordered import positions, running_totals
from lexiloom.operators.skew import deal, hot_keys, spread_join

COUNTS = {"big": 10, "rock": 10, "bigrock": 1, "b": 2, "ig": 3, "ro": 4, "ck": 4, "gro": 1}


def counts(spark, table=COUNTS):
    return spark.createDataFrame(list(table.items()), "gram string, cnt bigint")


def lines(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "key bigint, text string")


def test_unigram_fixture(spark):
    c = counts(spark, {"big": 10, "rock": 10, "bigrock": 1})
    got = {r.text: (r.words, r.logprob) for r in S.segment_unigram(lines(spark, ["bigrock", ""]), c, total=100).collect()}
    assert got["bigrock"][0] == ["big", "rock"]
    assert math.isclose(got["bigrock"][1], math.log10(0.0075), abs_tol=1e-8)
    assert got[""] == ([], 0.0)


def brute_unigram(text, n, max_len):
    score = lambda w: (
        math.log10(COUNTS[w] * 3 / (n * len(w))) if w in COUNTS else -math.log10(n) - 5 * len(w)
    )
    best = {len(text): (0.0, [])}
    for i in range(len(text) - 1, -1, -1):
        options = [
            (round(score(text[i : i + k]) + best[i + k][0], 9), -k) for k in range(1, min(max_len, len(text) - i) + 1)
        ]
        lp, k = max(options)
        best[i] = (lp, [text[i : i - k]] + best[i - k][1])
    return best[0]


def test_unigram_against_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("bigrock") for _ in range(rng.randint(1, 25))) for _ in range(60)] + ["bigrockbigrock"]
    got = S.segment_unigram(lines(spark, texts), counts(spark), max_len=8, total=100).collect()
    for r in got:
        lp, words = brute_unigram(r.text, 100, 8)
        assert r.words == words and math.isclose(r.logprob, lp, abs_tol=1e-6)
        assert "".join(r.words) == r.text


def test_bigram_against_brute_force(spark):
    rng = random.Random(4)
    pairs = {"big rock": 5, "rock big": 2, "ro ck": 1, "b ig": 2}
    texts = ["".join(rng.choice("bigrock") for _ in range(rng.randint(1, 9))) for _ in range(40)] + ["bigrock"]
    n, lam, top = 100, 0.7125, 4

    def p1(w):
        return COUNTS[w] * 2 / (n * len(w)) if w in COUNTS else 10 / (n * 10 ** (11 * len(w)))

    def best(text, i, prev):
        if i == len(text):
            return 0.0
        out = -math.inf
        for k in range(1, min(top, len(text) - i) + 1):
            w = text[i : i + k]
            if prev is None:
                if w not in COUNTS and k > 2:
                    continue
                step = math.log10((1 - lam) * p1(w))
            else:
                cond = pairs[f"{prev} {w}"] / COUNTS[prev] if f"{prev} {w}" in pairs and prev in COUNTS else p1(w)
                step = math.log10(lam * cond + (1 - lam) * p1(w))
            out = max(out, step + best(text, i + k, w))
        return out

    got = S.segment_bigram(
        lines(spark, texts + [""]), counts(spark), counts(spark, pairs), max_len=top, total=n
    ).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert "".join(r.words) == r.text
        assert math.isclose(r.logprob, best(r.text, 0, None), abs_tol=1e-6)


def test_fscore(spark):
    gold = spark.createDataFrame([(1, "a b b c"), (2, "only gold")], "line_no int, text string")
    pred = spark.createDataFrame([(1, "a b d")], "line_no int, text string")
    r = S.segmentation_fscore(gold, pred).first()
    assert (r.tp, r.fp, r.fn) == (1, 1, 2) and math.isclose(r.f1, 0.4)
    none = S.segmentation_fscore(gold, spark.createDataFrame([(1, "x")], "line_no int, text string")).first()
    assert none.f1 == 0.0


def test_score_of_segmentation(spark):
    df = spark.createDataFrame([(1, ["big", "rock", "big"]), (2, [])], "key int, words array<string>")
    got = {r.key: r.logprob for r in N.score_segmentation(df, counts(spark), total=100).collect()}
    assert math.isclose(got[1], 2 * math.log10(30 / 300) + math.log10(30 / 400), abs_tol=1e-9) and got[2] == 0.0


@pytest.mark.parametrize("hot", ["word", "prev"])
def test_pairs_of_a_hot_word_use_many_parts(spark, monkeypatch, hot):
    rows = [("big", f"w{i}") if hot == "prev" else (f"w{i}", "big") for i in range(200)] + [("ro", "ck")]
    pairs = spark.createDataFrame(rows, "prev string, word string")
    parts = {}

    def watched(left, right, on, how, spread):
        hot = hot_keys(left.select(*on), on, 10)
        parts[tuple(on)] = deal(left, hot, on, spread).select("__part").distinct().count()
        return spread_join(left, right, on, how, spread, rows_per_task=10)

    # As for tables too large to broadcast.
    monkeypatch.setattr(skew, "is_small", lambda df: False)
    monkeypatch.setattr(skew, "spread_join", watched)
    bigrams = spark.createDataFrame([("ro ck", 2)], "gram string, cnt bigint")
    got = N.bigram_conditional(pairs, counts(spark), bigrams, 100, N.PLAIN, spread=[F.lit(0)]).collect()
    assert parts[(hot,)] > 1
    p1 = {"big": 0.1, "ck": 0.04}
    want = {(p, w): (0.5 if p == "ro" else p1.get(w, 0.01), p1.get(w, 0.01)) for p, w in rows}
    assert len(got) == len(rows)
    assert all(math.isclose(x, y) for r in got for x, y in zip((r.cond, r.p1), want[r.prev, r.word]))


def test_pairs_keep_their_rows_and_columns(spark):
    rows = [(i, "ro", "ck") for i in range(3)] + [(3, None, "ck"), (4, "ro", None), (5, "x", "y")]
    pairs = spark.createDataFrame(rows, "id int, prev string, word string")
    bigrams = spark.createDataFrame([("ro ck", 2)], "gram string, cnt bigint")
    got = {r.id: (r.prev, r.word, r.cond, r.p1) for r in N.bigram_conditional(pairs, counts(spark), bigrams, 100, N.PLAIN, spread=["id"]).collect()}
    assert got[0] == got[1] == got[2] == ("ro", "ck", 0.5, 0.04) and got[5] == ("x", "y", 0.01, 0.01) and len(got) == 6
    plain = pairs.where("id < 3").select("prev", "word")
    again = N.bigram_conditional(plain, counts(spark), bigrams, 100, N.PLAIN, spread=[F.lit(0)]).collect()
    assert [(r.prev, r.word, r.cond, r.p1) for r in again] == [("ro", "ck", 0.5, 0.04)] * 3


def test_vocab_and_unknown_terms(spark):
    df = spark.createDataFrame([(0, 0, "b"), (0, 1, "a"), (1, 0, "b"), (1, 1, "c")], "doc int, pos int, term string")
    vocab = N.build_vocab(df, ["doc", "pos"])
    assert {r.term: r.ix for r in vocab.collect()} == {"b": 0, "a": 1, "c": 2}
    extra = spark.createDataFrame([("z",), ("a",)], "term string")
    with pytest.raises(Exception, match="not in the vocabulary"):
        N.encode(extra, vocab, spread=[F.lit(0)]).collect()
    known = vocab.unionByName(spark.createDataFrame([("[UNK]", 3)], "term string, ix bigint"))
    assert {r.term: r.ix for r in N.encode(extra, known, "[UNK]", spread=[F.lit(0)]).collect()} == {"z": 3, "a": 1}


def test_hot_keys_are_split_and_nothing_is_lost(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left"):
        got = spread_join(left, right, ["k"], how, ["id"], rows_per_task=100)
        want = left.join(right, "k", how)
        assert got.count() == want.count()
        assert got.select("k", "id", "v").exceptAll(want.select("k", "id", "v")).count() == 0


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_running_totals_do_not_depend_on_the_blocks(spark, blocks):
    df = spark.range(500).select(
        F.when(F.col("id") < 350, 1).otherwise(F.col("id") % 5).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("o"),
        "id",
    )
    got = running_totals(df, ["k"], ["o", "id"], {"t": F.col("id")}, blocks).collect()
    rows = sorted((r.k, r.o, r.id, r.t) for r in got)
    seen: dict = {}
    for k, _, i, t in rows:
        seen[k] = seen.get(k, 0) + i
        assert t == seen[k]
    numbers = sorted(r.pos for r in positions(df, [], ["o", "id"], blocks=blocks).collect())
    assert numbers == list(range(500))


@pytest.mark.parametrize("bound", [0, 200_000])
def test_lookup_is_the_same_with_and_without_broadcast(spark, monkeypatch, bound):
    monkeypatch.setattr(skew, "MAX_LOOKUP_ROWS", bound)
    left = spark.range(50).select((F.col("id") % 4).alias("k"), "id")
    table = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k bigint, v string")
    got = {(r.id, r.v) for r in skew.lookup_join(left, table, ["k"], "left", spread=["id"]).collect()}
    assert got == {(i, {0: "a", 1: "b", 2: "c"}.get(i % 4)) for i in range(50)}
    plan = skew.lookup_join(left, table, ["k"], "left", spread=["id"])._jdf.queryExecution().toString()
    assert ("__part" in plan) == (bound == 0)


def test_equal_rows_of_a_hot_key_use_many_parts(spark):
    left = spark.range(1000).select(F.lit("a").alias("k"), (F.col("id") % 50).alias("row"))
    hot = hot_keys(left, ["k"], rows_per_task=10)
    assert hot.count() == 1
    assert deal(left, hot, ["k"], ["row"]).select("__part").distinct().count() > 1
    for spread in ([], ["k"]):
        with pytest.raises(ValueError, match="spread"):
            spread_join(left, left.limit(1), ["k"], "inner", spread)


def test_no_more_hot_keys_than_partitions(spark):
    left = spark.range(20_000).select((F.col("id") % 3000).alias("k"), "id")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert hot_keys(left, ["k"], rows_per_task=1).count() <= n
    right = spark.range(3000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert spread_join(left, right, ["k"], "inner", ["id"], rows_per_task=1).count() == 20_000


def test_null_keys_join_only_if_asked(spark):
    left = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 50)], "k int, id int")
    right = spark.createDataFrame([(None, "n"), (1, "one")], "k int, v string")
    assert spread_join(left, right, ["k"], "inner", ["id"], rows_per_task=5).count() == 1
    assert spread_join(left, right, ["k"], "left", ["id"], rows_per_task=5).count() == 51
    safe = spread_join(left, right, ["k"], "inner", ["id"], rows_per_task=5, null_safe=True)
    assert safe.columns == ["k", "id", "v"] and safe.count() == 51


def test_positions_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 1), ("a", 5)], "k string, o int")
    got = {(r.k, r.o): r.pos for r in positions(df, ["k"], ["o"], blocks=3).collect()}
    assert got == {(None, 1): 0, (None, 2): 1, ("a", 1): 0, ("a", 5): 1}


# long lines and membership


def lines_of(rng, n, size):
    words = ["a", "ab", "aba", "ba", "bab", "c", "cab", "abc"]
    return [(f"l{i}", "".join(rng.choice(words + ["x", "yz"]) for _ in range(rng.randint(1, size)))) for i in range(n)]


WORDS = [("a", 50), ("ab", 20), ("aba", 9), ("ba", 20), ("bab", 5), ("c", 20), ("cab", 5), ("abc", 4), ("b", 10)]


@pytest.mark.parametrize("slab", [4, 7, 64])
def test_slabs_equal_rows(spark, slab):
    rng = random.Random(slab)
    lines = lines_of(rng, 60, 30) + [("empty", ""), ("none", None), ("é", "éabébaé" * 9)]
    df = spark.createDataFrame(lines, "key string, text string")
    counted = spark.createDataFrame(WORDS, "gram string, cnt bigint")
    rows = S.segment_unigram(df.where("text IS NOT NULL"), counted, max_len=4)
    want = {r.key: (r.words, round(r.logprob, 6)) for r in rows.collect() if r.words}
    for filtered in (False, True):
        got = {}
        for r in sorted(long_lines.segment_slabs(df, counted, max_len=4, slab=slab, filtered=filtered).collect(), key=lambda r: (r.key, r.start)):
            words, score = got.setdefault(r.key, ([], []))
            assert r.start == sum(map(len, words))
            words.append(r.word)
            score.append(r.logprob)
        assert {k: (w, round(sum(s), 6)) for k, (w, s) in got.items()} == want


def test_rolling_hashes():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aé日😀b") for _ in range(60)) for _ in range(20)]
    seen = {}
    for text in texts:
        rolling = long_lines.RollingHash(text)
        for a in range(60):
            for b in range(a + 1, min(61, a + 9)):
                h = int(rolling.of(np.array([a]), np.array([b]))[0])
                assert seen.setdefault(text[a:b], h) == h
    assert len(set(seen.values())) == len(seen)


def test_a_line_of_a_million_characters(spark):
    rng = random.Random(9)
    text = "".join(rng.choice(["the", "cat", "sat", "on", "mat", "q", "xx"]) for _ in range(400_000))[:1_000_000]
    counted = spark.createDataFrame([("the", 9), ("cat", 4), ("sat", 4), ("on", 5), ("mat", 3)], "gram string, cnt bigint")
    df = spark.createDataFrame([("long", text)], "key string, text string")
    out = long_lines.segment_slabs(df, counted, max_len=5, slab=65_536)
    got = sorted((r.start, r.word) for r in out.select("start", "word").collect())
    assert "".join(w for _, w in got) == text and len(got) > 300_000
    # The best words of the whole line, from its end, in whole numbers.
    n, scores = 25, {}
    for word, count in (("the", 9), ("cat", 4), ("sat", 4), ("on", 5), ("mat", 3)):
        scores[word] = round(math.log10(count * 3 / (n * len(word))) * 10**9)
    unseen = [round((-math.log10(n) - 5 * k) * 10**9) for k in range(6)]
    best, pick = [0] * (len(text) + 5), [0] * len(text)
    for p in range(len(text) - 1, -1, -1):
        options = [(scores.get(text[p : p + k], unseen[k]) + best[p + k], -k) for k in range(1, min(5, len(text) - p) + 1)]
        best[p], pick[p] = max(options)
    p, want = 0, []
    while p < len(text):
        want.append((p, text[p : p - pick[p]]))
        p -= pick[p]
    assert got == want


def test_membership(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(3000)] + [(None,), ("k1",)], "k string")
    held = membership(keys)
    probe = spark.range(20000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    found = probe.where(held.may_hold(F.col("k"))).collect()
    assert {f"k{i}" for i in range(3000)} <= {r.k for r in found} and len(found) < 3000 + 17000 * 0.02
    assert membership(keys.limit(0)).may_hold(F.col("k")) is not None
    assert probe.where(membership(keys.limit(0)).may_hold(F.col("k"))).count() == 0


def test_filtered_lattices_and_pairs(spark):
    """With and without the filters the same words, and fewer edges to look up."""
    rng = random.Random(3)
    df = spark.createDataFrame(lines_of(rng, 40, 12), "key string, text string")
    counted = spark.createDataFrame(WORDS, "gram string, cnt bigint")
    pairs = spark.createDataFrame([("a ba", 4), ("ab c", 3), ("c ab", 2), ("ba b", 2)], "gram string, cnt bigint")
    held, held_pairs = membership(counted.select("gram")), membership(pairs.select("gram"))
    plain = S.segment_bigram(df, counted, pairs, max_len=4).collect()
    assert sorted(plain) == sorted(S.segment_bigram(df, counted, pairs, max_len=4, within=held, pairs_within=held_pairs).collect())
    assert S.candidate_words(df, max_len=4, within=held).count() < 0.7 * S.candidate_words(df, max_len=4).count()
    assert S.candidate_pairs(df, max_len=4, within=held_pairs).count() < 0.3 * S.candidate_pairs(df, max_len=4).count()
    tokens = df.select(F.split("text", "b").alias("tokens"))
    both = N.ngram_counts(tokens, (1, 2)).collect()
    assert sorted(both) == sorted(N.ngram_counts(tokens, 1).collect() + N.ngram_counts(tokens, 2).collect())
    kept = {r.gram: r.cnt for r in N.ngram_counts(tokens, 1, within=held).collect()}
    assert all(kept[r.gram] == r.cnt for r in N.ngram_counts(tokens, 1).collect() if r.gram in dict(WORDS))


def test_slabs_are_worked_on_in_slices_of_characters():
    import pandas as pd

    from lexiloom.operators import long_lines as L

    sizes = [3, L.SLICE - 2, 0, 5, 2 * L.SLICE, 1, 1]
    batch = pd.DataFrame({"id": range(len(sizes)), "piece": ["x" * n for n in sizes]})
    slices = list(L._slices([batch.iloc[:0], batch], "piece"))
    assert [list(s["id"]) for s in slices] == [[0], [1, 2], [3], [4], [5, 6]]


def test_words_of_a_bucket_are_placed_by_slab_number():
    import pandas as pd

    from lexiloom.operators import long_lines as L

    slabs = pd.DataFrame({"id": [7, 3], "key": ["a", "b"], "at": [0, 0], "own": [2, 3], "last": [True, True]})
    edges = pd.DataFrame({"id": [3, 5, 7], "start": [1, 0, 0], "len": [2, 1, 2], "score": [-1, -2, -3]})
    held = L.Bucket(slabs, edges, np.array([-10, -20], np.int64))
    at = dict(zip(held.slabs["key"], held.first.tolist()))
    assert held.scores[at["b"] + 1, 1] == -1 and held.scores[at["a"], 1] == -3
    assert held.scores[at["b"], 0] == -10 and held.scores[at["a"], 0] == -10


def test_pairs_of_lines_folded_together(spark, monkeypatch):
    """Lines of one key are lines of their own, whatever the bucket and the slice; the score is that of the path."""
    from lexiloom.operators import word_pairs

    rng = random.Random(8)
    texts = ["".join(rng.choice("abc\U0001f600") for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    df = spark.createDataFrame([(f"k{i % 7}", t) for i, t in enumerate(texts)] + [("k0", ""), ("k1", None)], "key string, text string")
    counted = spark.createDataFrame(WORDS, "gram string, cnt bigint")
    pairs = spark.createDataFrame([("a ba", 4), ("ab c", 3), ("c ab", 2), ("ba b", 2), ("zz a", 9)], "gram string, cnt bigint")
    alone = {}
    for i, t in enumerate(texts[:6]):  # a line without company
        (r,) = S.segment_bigram(lines(spark, [t]), counted, pairs, max_len=4).collect()
        alone[i] = (t, r.words, r.logprob)
    monkeypatch.setattr(word_pairs, "BUCKET", 100)
    monkeypatch.setattr(long_lines, "SLICE", 64)
    got = S.segment_bigram(df, counted, pairs, max_len=4).collect()
    assert sorted((r.key, r.text) for r in got) == sorted([(f"k{i % 7}", t) for i, t in enumerate(texts)] + [("k0", "")])
    assert all("".join(r.words) == r.text for r in got)
    for t, words, logprob in alone.values():
        assert (words, logprob) in [(r.words, r.logprob) for r in got if r.text == t]


AWKWARD = [None, "", " \t　", "a", "a b", " a  b\x1ca\x85b ", "a b c\n", "b b b b", "ä ​ a", "c a b a b c " * 40]


def _grams_of(texts, sizes):
    from collections import Counter

    words = [(t or "").split() for t in texts]
    return Counter((n, " ".join(w[i : i + n])) for w in words for n in sizes for i in range(len(w) - n + 1))


@pytest.mark.parametrize("chunk", [1, 1 << 22])
def test_ngrams_of_texts_are_counted_by_size(spark, monkeypatch, chunk):
    monkeypatch.setattr(N, "CHUNK_BYTES", chunk)
    df = spark.createDataFrame([(t,) for t in AWKWARD], "text string")
    want = _grams_of(AWKWARD, (1, 2, 3))
    got = {(r.size, r.gram): r.cnt for r in N.text_ngram_counts(df, (1, 2, 3)).collect()}
    assert got.pop((0, None)) == sum(c for (n, _), c in want.items() if n == 1) and got == want
    wanted = spark.createDataFrame([("a",), ("b a",), ("never seen",), ("a b c",)], "gram string")
    few = {(r.size, r.gram): r.cnt for r in N.text_ngram_counts(df, (1, 2, 3), within=wanted).collect()}
    assert few.pop((0, None)) == sum(c for (n, _), c in want.items() if n == 1)
    assert {(1, "a"), (2, "b a"), (3, "a b c")} <= set(few) and few.items() <= want.items()
    assert N.text_ngram_counts(df.limit(3), (1, 2), within=wanted).count() == 0
    assert N.text_ngram_counts(df.limit(0), (1,), within=wanted.limit(0)).count() == 0


def test_ngrams_of_arrays_and_texts_agree(spark):
    """An n-gram that many lines share leaves a worker once, not once for each line."""
    df = spark.createDataFrame([("a b a b c",)] * 200, "text string").coalesce(1)
    tokens = df.select(F.split("text", " ").alias("tokens"))
    want = {"a b": 400, "b a": 200, "b c": 200}
    assert {r.gram: r.cnt for r in N.ngram_counts(df, 2, "text").collect()} == want
    assert {r.gram: r.cnt for r in N.ngram_counts(tokens, 2).collect()} == want
    assert N._counts_in_chunks(tokens, [2], "tokens").count() == 4
    odd = spark.createDataFrame([(["a", None, "b"],), (None,), ([],), ([None, None, "c"],)], "tokens array<string>")
    assert {r.gram: r.cnt for r in N.ngram_counts(odd, (1, 3)).collect()} == {"a": 1, None: 3, "b": 1, "c": 2, "a b": 1}


def test_unwanted_grams_stay_in_the_worker(spark):
    from lexiloom.operators.long_lines import gram_bits

    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(3000)),)], "text string")
    wanted = spark.createDataFrame([("w1",), ("w1 w2",), ("w9 w10",)], "gram string")
    known = spark.sparkContext.broadcast(gram_bits(wanted))
    sent = {r.gram for r in N._counts_in_chunks(df, (1, 2), "text", known).collect()}
    assert {"w1", "w1 w2", "w9 w10", None} <= sent and len(sent) < 100


def test_repeated_pairs_without_a_word_keep_their_rows(spark):
    pairs = spark.createDataFrame([(None, "ck")] * 3 + [("ro", "ck")] * 2 + [("ro", None)], "prev string, word string")
    bigrams = spark.createDataFrame([("ro ck", 2), ("ro x", 1)], "gram string, cnt bigint")
    got = N.bigram_conditional(pairs, counts(spark), bigrams, 100, N.PLAIN, spread=[F.lit(0)]).collect()
    assert sorted((r.prev or "", r.word or "") for r in got) == [("", "ck")] * 3 + [("ro", "")] + [("ro", "ck")] * 2
    assert {r.cond for r in got if r.prev == "ro" and r.word} == {0.5}


def test_segment_bigram_plans_hold_values(spark):
    """The total and the hot keys are values in the plan, which the driver keeps for every job, not plans of their own."""
    df = spark.createDataFrame([(1, "abab"), (2, "ba")], "key int, text string")
    one, two = (spark.createDataFrame(rows, "gram string, cnt bigint") for rows in ([("a", 2), ("ab", 3)], [("ab ab", 1)]))
    for counts, pairs in ((one, two), (one.limit(0), two.limit(0))):
        out = S.segment_bigram(df, counts, pairs, max_len=2)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "subquery" not in plan
        assert {r.key for r in out.collect()} == {1, 2}
    assert [r.words for r in S.segment_bigram(df, one, two, max_len=2).orderBy("key").collect()][0] == ["ab", "ab"]
