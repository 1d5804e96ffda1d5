"""The pipeline's stages on awkward rows, clashing columns and an empty table."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from lexiloom.llm import quality_rules
from lexiloom.llm.store import stored
from tests.llm import brute
from tests.llm.data import awkward, empty, frame

CLASHING = [
    "'a' AS Shard", "1 AS PLACE", "2 AS size", "3 AS block", "'b' AS src", "4 AS fp", "5 AS component_id", "6 AS root",
    "7 AS length", "8 AS part", "'c' AS ids", "9 AS copies", "10 AS target", "'e' AS `row`", "11 AS n_words",
]


def good(rng, n):
    """A text that the quality rules keep."""
    common = ["the", "of", "and", "to", "in", "is", "that", "with", "for", "was"]
    return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("aeioubcdfg") for _ in range(rng.randint(3, 9))) for _ in range(n)) + "."


def with_clashes(df):
    taken = {c.lower() for c in df.columns}
    extra = [c for c in CLASHING if c.split(" AS ")[1].strip("`").lower() not in taken]
    return df.selectExpr("*", *extra)


def test_stages_on_awkward_rows(spark, tokenizer):
    rng = random.Random(5)
    texts = [good(rng, rng.randint(80, 300)) for _ in range(12)]
    rows = [*awkward(), *((1000 + i, t, f"s{i % 2}") for i, t in enumerate(texts))]
    rows += [(2000 + i, texts[0], "s0") for i in range(4)] + [(2100, texts[1].replace("the", "the", 1), None), (None, texts[2], "s1")]
    docs = with_clashes(frame(spark, rows))
    columns, df, frames = docs.columns, docs, []
    for name, stage in corpus_pipeline.STAGES:
        df = stored(stage(spark, df, ""))
        frames.append(df.collect())
        if name != "packing":
            assert df.columns == columns, name
    judged, once, apart, mixed, packed = frames
    verdicts = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert {r.doc_id for r in judged} == {i for i, stays in verdicts.items() if stays}
    assert {r.text for r in judged} >= set(texts)
    assert len({r.text for r in once}) == len(once) and {r.text for r in once} == {r.text for r in judged}
    kept = {r.text: r.doc_id for r in once}
    assert kept[texts[0]] == 2003 and kept[texts[2]] == 1002
    fps = [(r.doc_id, brute.fingerprint(r.text)) for r in once]
    assert {r.doc_id for r in apart} == set(brute.hamming_components(fps))
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= {r.doc_id for r in apart} and max(copies.values()) <= 2
    assert all((r["Shard"], r["PLACE"]) == ("a", 1) for r in mixed)
    ids = {r.doc_id: brute.token_ids(tokenizer, r.text) for r in apart}
    assert sum(r.length for r in packed) == sum(len(ids[i]) * n for i, n in copies.items())
    assert all(brute.crc(ids[r.doc_id][r.start : r.start + r.length]) == r.ids_crc32 for r in packed)


@pytest.mark.parametrize("clashing", [False, True])
def test_stages_on_an_empty_table(spark, clashing):
    df = with_clashes(empty(spark)) if clashing else empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        df = stored(stage(spark, df, ""))
        assert df.count() == 0
