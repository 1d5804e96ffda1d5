import random
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiloom.functions import arrays as A
from lexiloom.functions import text as T


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(col.alias("v")).first()["v"]


def test_tokens_split_on_every_python_space(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    text = "".join("x" + s for s in spaces) + "x"
    assert one(spark, T.tokens(F.col("t")), t=text) == text.split()
    assert one(spark, T.tokens(F.col("t")), t="  a ​ b ") == "  a ​ b ".split()
    assert one(spark, T.tokens(F.col("t")), t="") == []


def map_by_hand(text):
    tokens, at, gap = [], [], True
    for c in text:
        if c in " \t\r\n ":
            gap = True
        else:
            tokens = tokens + [c] if gap else tokens[:-1] + [tokens[-1] + c]
            gap = False
        at.append(len(tokens) - 1)
    return tokens, at


@pytest.mark.parametrize("text", ["  ab c d\te", "a", " ", "x y z\r\n", "\U0001f600 é \U0001f600b"])
def test_offsets(spark, text):
    tokens, at = map_by_hand(text)
    assert one(spark, T.qa_tokens(F.col("t")), t=text) == tokens
    assert one(spark, T.char_to_token(F.col("t")), t=text) == at
    starts = one(spark, T.token_starts(F.col("t")), t=text)
    assert [text[s : s + len(w)] for s, w in zip(starts, tokens)] == tokens
    for i, token in enumerate(at):
        assert one(spark, T.token_at(F.col("t"), F.lit(i)), t=text) == token


def test_normalize_answer(spark):
    cases = {"The  U.S.": "us", "a-an the.x": "aan thex", "An apple, a day": "apple day", "théa a": "théa", "": ""}
    for text, want in cases.items():
        assert one(spark, T.normalize_answer(F.col("t")), t=text) == want


def test_markup(spark):
    toks = ["a", "<b>", "x<c>", "<d>y", "<>", "<e", "f>"]
    assert one(spark, T.drop_markup_tokens(F.col("t")), t=toks) == ["a", "x<c>", "<>", "<e", "f>"]
    assert one(spark, T.markup_before(F.col("t")), t=toks) == [0, 0, 1, 1, 2, 2, 2]
    assert one(spark, T.count_markup_before(F.col("t"), F.lit(3)), t=toks) == 1


@pytest.mark.parametrize("word", ["Hello", "a", "ab", "banana!", "éx~"])
def test_semichar(spark, word):
    want = [0.0] * 300
    alphabet = string.printable
    if word[0] in alphabet:
        want[alphabet.index(word[0])] = 1.0
    for c in word[1:-1]:
        if c in alphabet:
            want[100 + alphabet.index(c)] += 1
    if word[-1] in alphabet:
        want[200 + alphabet.index(word[-1])] = 1.0
    assert one(spark, T.semichar_features(F.col("t")), t=word) == want
    assert one(spark, T.unknown_chars(F.col("t")), t=word) == sum(c not in alphabet for c in word)


def test_noise(spark):
    word = lambda a, i, **k: one(spark, T.noisy_token(F.lit("hello"), F.lit(a), F.lit(i), **k))
    assert [word(0, 1), word(1, 1), word(2, 1), word(2, 3)] == ["hello", "hllo", "hlelo", "helol"]
    assert word(2, 1, drop_tail=True) == "hle"
    assert one(spark, T.noisy_token(F.lit("ab"), F.lit(1), F.lit(1))) == "ab"


def test_small_helpers(spark):
    assert one(spark, T.join_wordpieces(F.col("t")), t=["em", "##bed", "##ding", "x"]) == "embedding x"
    assert one(spark, T.until_eos(F.col("t")), t=" a b <EOS> c <EOS>") == "a b "
    assert tuple(one(spark, T.split_tag(F.col("t")), t="B-NP-x")) == ("B", "NP-x")
    assert tuple(one(spark, T.split_tag(F.col("t")), t="O")) == ("O", None)
    with pytest.raises(Exception, match="tag without a type"):
        one(spark, T.split_tag(F.col("t")), t="B")


def test_running_sum_and_bags(spark):
    for n in (0, 1, 63, 64, 65, 300):
        values = list(range(1, n + 1))
        got = spark.range(1).select(
            A.running_sum(F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<int>")).alias("v")
        ).first()["v"]
        assert got == [i * (i + 1) // 2 for i in values]
    assert one(spark, A.bag_overlap(F.col("a"), F.col("b")), a=list("aabcc"), b=list("abbccc")) == 4


def test_project_to_source_text(spark):
    cases = [
        ("steve smith", "Steve Smith's", "Steve Smith"),
        ("1895", "(1895-1943).", "1895"),
        ("cafe x", "Café x, y", "Café x"),
        ("nope", "abc", "abc"),
        ("", "abc", "abc"),
    ]
    for pred, orig, want in cases:
        assert one(spark, T.project_to_source_text(F.col("p"), F.col("o")), p=pred, o=orig) == want


def test_bags_of_long_arrays(spark):
    rng = random.Random(7)
    for n in (200, 257, 900):
        a = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n)]
        b = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n)]
        assert one(spark, A.bag_overlap(F.col("a"), F.col("b")), a=a, b=b) == sum((Counter(a) & Counter(b)).values())
