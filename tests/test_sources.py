import gzip
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lexiloom.sources import conll, lines, qa_json, tables


def test_lines_of_a_split_file(spark, tmp_path):
    want = [f"line {i} " + "x" * (i % 90) for i in range(5000)]
    (tmp_path / "a.txt").write_text("\n".join(want) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r.line_no: r.text for r in lines.read_lines(spark, str(tmp_path / "a.txt")).collect()}
        assert spark.read.text(str(tmp_path / "a.txt")).rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [got[i] for i in range(len(want))] == want


CONLL = "\n\nA a B-X\nB b I-X\n\n  \n\nC c O\n\t\nD d B-Y\nE e I-Y\n\n"


def by_hand(text):
    text = re.sub(r"\n\s*\n", r"\n\n", text).rstrip()
    return text.split("\n\n")


@pytest.mark.parametrize("slab", [1, 2, 65536])
def test_conll(spark, tmp_path, monkeypatch, slab):
    monkeypatch.setattr(lines, "SLAB", slab)
    with gzip.open(tmp_path / "t.gz", "wt") as f:
        f.write(CONLL)
    got = [tuple(r) for r in conll.read_conll(spark, str(tmp_path / "t.gz")).orderBy("sent_id", "pos").collect()]
    want = [s.split("\n") for s in by_hand(CONLL) if s.strip()]
    assert got == [(i, j, line.split()[0], line.split()[2]) for i, s in enumerate(want) for j, line in enumerate(s)]
    assert conll.read_conll(spark, str(tmp_path / "t.gz"), 1, -1).columns == ["sent_id", "pos", "token"]
    with pytest.raises(Exception, match="too few columns"):
        conll.read_conll(spark, str(tmp_path / "t.gz"), 0, 3).collect()


def test_sentence_counts(spark, tmp_path):
    texts = {"a": CONLL, "b": "", "c": "x y z", "d": "\nx\n\ny\n", "e": "  \n\nx\n", "f": "\n \n\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    got = {r.file[-5]: r.n for r in conll.count_sentences(spark, str(tmp_path)).collect()}
    assert got == {name: len(by_hand(text)) for name, text in texts.items()}


def test_tag_pairs_and_writer(spark, tmp_path):
    (tmp_path / "p.txt").write_text("w B-X B-X\nw x O I-X\n\nw O O\n")
    got = [tuple(r) for r in conll.read_tag_pairs(spark, str(tmp_path / "p.txt")).orderBy("sent_id", "pos").collect()]
    assert got == [(0, 0, "B-X", "B-X"), (0, 1, "O", "I-X"), (1, 0, "O", "O")]
    df = spark.createDataFrame([(3, 0, "B-X"), (3, 1, "I-X"), (9, 0, "O")], "seq int, pos int, tag string")
    conll.write_tagged(df, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "B-X\nI-X\n\nO\n"
    (tmp_path / "bad.txt").write_text("w O\n")
    with pytest.raises(Exception, match="too few columns"):
        conll.read_tag_pairs(spark, str(tmp_path / "bad.txt")).collect()


def test_counts_and_lexicon(spark, tmp_path):
    (tmp_path / "c.txt").write_text('a\t3\n"b\t2\na\t4\nx y\t1\n')
    assert {r.gram: r.cnt for r in tables.read_counts(spark, str(tmp_path / "c.txt")).collect()} == {"a": 7, '"b': 2, "x y": 1}
    (tmp_path / "bad.txt").write_text("a\tthree\n")
    with pytest.raises(Exception):
        tables.read_counts(spark, str(tmp_path / "bad.txt")).collect()
    (tmp_path / "l.txt").write_text("Dog old\ncat Kitty\nDOG Hound pup\nlone\n")
    got = {(r.head, r.neighbour) for r in tables.read_lexicon(spark, str(tmp_path / "l.txt")).collect()}
    assert got == {("dog", "hound"), ("dog", "pup"), ("cat", "kitty")}


def test_substitution_files(spark, tmp_path):
    (tmp_path / "q.txt").write_text("1\ta  big dog\n0\tcat\n")
    got = [tuple(r) for r in tables.read_lexsub_queries(spark, str(tmp_path / "q.txt")).orderBy("qid").collect()]
    assert got == [(0, 1, ["a", "big", "dog"]), (1, 0, ["cat"])]
    (tmp_path / "g.txt").write_text("side.n\tteam part team\n")
    assert tables.read_lexsub_gold(spark, str(tmp_path / "g.txt")).first()["gold"] == ["team", "part"]


def test_bitext_skips_outer_blank_lines(spark, tmp_path):
    (tmp_path / "s.txt").write_text("\n\nA b\nC\n\nD\n\n")
    (tmp_path / "t.txt").write_text("x\nY z\n")
    got = [tuple(r) for r in tables.read_bitext(spark, str(tmp_path / "s.txt"), str(tmp_path / "t.txt")).orderBy("pair_id").collect()]
    assert got == [(0, ["a", "b"], ["x"]), (1, ["c"], ["y", "z"])]
    assert tables.read_bitext(spark, str(tmp_path / "s.txt"), str(tmp_path / "t.txt"), 1).count() == 1


def test_squad_and_nq(spark, tmp_path):
    squad = {"data": [{"paragraphs": [{"context": "c", "qas": [
        {"id": "1", "question": "q", "answers": [{"text": "c", "answer_start": 0}]},
        {"id": "2", "question": "q", "answers": [], "is_impossible": True}]}]}]}
    (tmp_path / "s.json").write_text(json.dumps(squad, indent=2))
    got = {r.qid: (r.context, len(r.answers), r.is_impossible) for r in qa_json.read_squad(spark, str(tmp_path / "s.json")).collect()}
    assert got == {"1": ("c", 1, False), "2": ("c", 0, True)}


def test_prediction_maps(spark, tmp_path):
    (tmp_path / "bert_19.json").write_text(json.dumps({"q1": [{"text": "a", "probability": 0.9, "start_logit": 1, "end_logit": 2}, {"text": "b", "probability": 0.1, "start_logit": 0, "end_logit": 0}]}, indent=1))
    got = [tuple(r)[:5] for r in qa_json.read_predictions(spark, str(tmp_path)).orderBy("rank").collect()]
    assert got == [("bert", "bert_19", "q1", 1, "a"), ("bert", "bert_19", "q1", 2, "b")]
    df = spark.createDataFrame([(f"q{i}", i / 10) for i in range(10)], "qid string, na_prob double")
    qa_json.write_predictions(df, str(tmp_path / "o" / "albert_1.json"), "na_prob", rows_per_object=3)
    back = qa_json.read_predictions(spark, str(tmp_path / "o"), "na_prob", lines=True)
    assert back.select("qid", "na_prob").exceptAll(df).count() == 0 and back.count() == 10
    assert back.first()["model"] == "albert"


def test_vectors_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", [3.0, 4.00004])], "word string, vec array<double>")
    tables.write_vectors(df, str(tmp_path / "v"))
    assert spark.read.text(str(tmp_path / "v")).first()[0] == "a 3.0000 4.0000 "
    vec = tables.read_vectors(spark, str(tmp_path / "v")).select(F.get("vec", 0)).first()[0]
    assert round(vec, 6) == 0.6


# one JSON object read by many tasks

NASTY = ['a,b', '"', '\\', '\\"', '}', '{[', '],"x":[', '\\u0041,', 'é,日本', '\n,\t', ',', ',,', '', '\\\\",', "'", '{"qid": [1, 2]}']


def nasty(rng, n):
    return "".join(rng.choice(NASTY) for _ in range(rng.randint(0, n)))


@pytest.fixture
def tiny_ranges(spark):
    """Files are read in ranges of a few bytes, so borders fall into strings, escapes and letters."""
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 1])
def test_prediction_objects_in_ranges(spark, tmp_path, tiny_ranges, indent):
    rng = random.Random(5)
    want = {}
    for model in ("a_1", "b_2", "none_3"):
        found = {f"q{i}{nasty(rng, 2)}": nasty(rng, 6) for i in range(40)} if model != "none_3" else {}
        want |= {(model, q): t for q, t in found.items()}
        (tmp_path / f"{model}.json").write_text(json.dumps(found, indent=indent, ensure_ascii=bool(indent)))
    text = qa_json.object_entries(spark, str(tmp_path))
    assert spark.read.option("lineSep", ",").text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert text.count() == len(want)
    got = qa_json.read_predictions(spark, str(tmp_path), "best").collect()
    assert {(r.run, r.qid): r.text for r in got} == want and len(got) == len(want)


def test_nbest_objects_in_ranges(spark, tmp_path, tiny_ranges):
    rng = random.Random(6)
    entry = lambda: {"text": nasty(rng, 4), "probability": rng.random(), "start_logit": 1.5, "end_logit": -2}
    found = {f"q{i}": [entry() for _ in range(rng.randint(0, 4))] for i in range(25)}
    (tmp_path / "m_nbest.json").write_text(json.dumps(found))
    got = {(r.qid, r["rank"]): (r.text, r.probability) for r in qa_json.read_predictions(spark, str(tmp_path)).collect()}
    assert got == {(q, k + 1): (e["text"], e["probability"]) for q, es in found.items() for k, e in enumerate(es)}


@pytest.mark.parametrize("indent", [None, 2])
def test_articles_in_ranges(spark, tmp_path, tiny_ranges, indent):
    rng = random.Random(7)
    question = lambda i: {"id": f"q{i}", "question": nasty(rng, 3), "answers": [{"text": nasty(rng, 2), "answer_start": i}] * (i % 3)}
    articles = [
        {"title": nasty(rng, 2), "paragraphs": [{"context": nasty(rng, 8), "qas": [question(10 * a + p) for _ in range(a % 3)]} for p in range(a % 4)]}
        for a in range(12)
    ]
    whole = {"version": "v,1", "meta": [1, {"data": [2, 3]}, "x"], "data": articles, "more": {"a": [1, 2], "b": "]}"}, "n": 4}
    for name, held in (("a", whole), ("b", {"data": articles[:3]}), ("c", {"data": []})):
        (tmp_path / f"{name}.json").write_text(json.dumps(held, indent=indent))
    one_task = spark.read.schema(qa_json.SQUAD_SCHEMA).option("multiLine", "true").json(str(tmp_path)).selectExpr("inline(data)")
    want = one_task.selectExpr("explode(paragraphs) AS p").selectExpr("p.context", "explode(p.qas) AS q").selectExpr("q.id", "q.question", "context", "q.answers")
    got = qa_json.read_squad(spark, str(tmp_path)).select("qid", "question", "context", "answers")
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, (tuple(r) for r in want.collect())))
