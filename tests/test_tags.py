import random

import pytest
from pyspark.sql import functions as F

from lexiloom.operators import tags as C


def seqs(spark, *rows):
    data = [(s, p, g, d) for s, (gold, pred) in enumerate(rows) for p, (g, d) in enumerate(zip(gold, pred))]
    return spark.createDataFrame(data, "seq int, pos int, gold string, pred string")


def brute_spans(tags):
    """Spans by growing the open chunk token by token."""
    out, open_at = [], None
    prev = ("O", None)
    for i, t in enumerate([*tags, "O"]):
        now = ("O", None) if t == "O" else tuple(t.split("-", 1))
        cut = prev[1] != now[1] or now[0] in "BS" or prev[0] in "ES"
        if prev[0] != "O" and (now[0] == "O" or cut):
            out.append((open_at, i - 1, prev[1]))
        if now[0] != "O" and (prev[0] == "O" or cut):
            open_at = i
        prev = now
    return out


def test_fixture(spark):
    df = seqs(spark, (["B-NP", "I-NP", "O", "B-VP"], ["B-NP", "I-NP", "O", "B-NP"]))
    r = C.chunk_scores(C.chunk_spans(df, "gold"), C.chunk_spans(df, "pred")).first()
    assert (r.gold, r.predicted, r.correct, r.precision, r.recall, r.f1) == (2, 2, 1, 50.0, 50.0, 50.0)
    per = {r.type: r for r in C.chunk_report(C.chunk_spans(df, "gold"), C.chunk_spans(df, "pred")).collect()}
    assert per["VP"].f1 == 0.0 and per["NP"].precision == 50.0 and per["NP"].recall == 100.0
    two = seqs(spark, (["B-X", "I-Y"], ["O", "O"]))
    assert C.chunk_spans(two, "gold").count() == 2


@pytest.mark.parametrize("slab", [2, 5, 65536])
def test_spans_against_brute_force(spark, slab):
    rng = random.Random(slab)
    tags = ["O", "O"] + [f"{p}-{t}" for p in "BIES" for t in "XY"] + ["I-X"] * 6
    rows = [[rng.choice(tags) for _ in range(rng.randint(1, 40))] for _ in range(40)] + [["B-X"] + ["I-X"] * 30]
    df = seqs(spark, *[(r, r) for r in rows])
    got = {(r.seq, r.start, r.end, r.type) for r in C.chunk_spans(df, "gold", slab=slab).collect()}
    assert got == {(s, *span) for s, r in enumerate(rows) for span in brute_spans(r)}


def test_flat_sequences_continue_chunks(spark):
    df = seqs(spark, (["B-X"], ["B-X"]), (["I-X", "O"], ["I-X", "O"]))
    assert C.chunk_spans(df, "gold").count() == 2
    assert C.chunk_spans(C.flatten_sequences(df), "gold").count() == 1


def test_accuracy_and_argmax(spark):
    df = seqs(spark, (["B-X", "O", "O", "I-X"], ["B-X", "O", "B-X", "O"]))
    r = C.tag_accuracy(df).first()
    assert (r.n_tokens, r.accuracy, r.accuracy_inside) == (4, 50.0, 50.0)
    scores = spark.createDataFrame([(1, [0.1, 0.7, 0.7])], "id int, scores array<double>")
    labels = spark.createDataFrame([(0, "O"), (1, "B"), (2, "I")], "ix bigint, label string")
    assert C.argmax_label(scores, labels, spread=["id"]).first()["label"] == "B"
    assert scores.select(C.argmax_index(F.col("scores"))).first()[0] == 1


def test_null_sequences_are_sequences(spark):
    rows = [(None, 0, "B-X"), (None, 1, "I-X"), ("s", 0, "O"), ("s", 1, "B-Y")]
    df = spark.createDataFrame(rows, "seq string, pos int, tag string")
    for slab in (1, 64):
        got = {(r.seq, r.start, r.end, r.type) for r in C.chunk_spans(df, slab=slab).collect()}
        assert got == {(None, 0, 1, "X"), ("s", 1, 1, "Y")}


def test_noise_is_seeded_and_keeps_the_first_letter(spark):
    words = ["ab", "abcdef", "hello", "wording"] * 20
    df = spark.createDataFrame([(i, words) for i in range(4)] + [(9, [])], "seq int, tokens array<string>")
    one, again, other = (C.noise_tokens(df, s).orderBy("seq").collect() for s in (3, 3, 4))
    assert one == again != other
    for row in one:
        for before, after in zip(words, row.tokens):
            assert after[:1] == before[:1] and len(before) - len(after) in (0, 1)
            assert set(after) <= set(before) and (len(before) > 2 or after == before)
    assert any(a != b for row in one for a, b in zip(words, row.tokens)) and one[-1].tokens == []
