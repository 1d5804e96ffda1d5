"""The registered corpus queries and the pipeline, over whole small tables."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from lexiloom.llm import quality_rules
from tests.compare import difference, duck
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


def rows_of(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", ["op1_url_filter", "op4_exact_dedup"])
def test_against_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(got, duck(SF_DIR).execute(entry_module.oracle_sql()[name]).fetchdf()) is None


def test_op2(spark, docs):
    want = []
    for i, t, _ in docs:
        spans = brute.pii_base(t)
        text = ",".join(f"{k}:{a}:{b}" for k, v in spans.items() for a, b in v)
        want.append((i, *map(len, spans.values()), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(tuple(r)[:6] for r in rows_of(spark, "op2_pii")) == want


def test_op3(spark, docs):
    want = []
    for i, t, _ in docs:
        found = brute.secret_base(t)
        n = Counter(k for k, _, _ in found)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        want.append((i, n["assign"], n["access"], n["hex"], hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(tuple(r)[:5] for r in rows_of(spark, "op3_secrets")) == want


def test_op5_and_op8(spark, docs, tokenizer):
    start, want, pieces = 0, [], Counter()
    for i, t, _ in docs:
        ids = brute.token_ids(tokenizer, t)
        want.append((i, start, len(ids), brute.crc(ids)))
        start += len(ids)
        at = 0
        for size in [2048] * (len(ids) // 2048) + [1 << b for b in range(10, -1, -1) if len(ids) % 2048 >> b & 1]:
            pieces[i, at, size, brute.crc(ids[at : at + size]), len(ids)] += 1
            at += size
    assert sorted(tuple(r) for r in rows_of(spark, "op5_simple8b")) == want
    got = rows_of(spark, "op8_packing")
    assert Counter(tuple(r)[:5] for r in got) == pieces
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and {r.offset for r in got} == {0}


def test_op6(spark, docs):
    want = [(i, *w) for (i, _, _), w in zip(docs, brute.repeats([t for _, t, _ in docs]))]
    assert sorted(tuple(r) for r in rows_of(spark, "op6_suffix_dedup")) == want


def test_op7(spark, docs):
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(brute.WORD.findall(t or ""))
    want, source = brute.targets(sizes), {i: s for i, _, s in docs}
    taken = Counter()
    for r in rows_of(spark, "op7_mixing"):
        taken[source[r.doc_id]] += r.taken
        assert r.taken <= 2 * r["size"] and abs(r.target - want[source[r.doc_id]]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 0.05 * want[s] + 10 for s in sizes)


def test_op9(spark, docs):
    got = {r.doc_id: r for r in rows_of(spark, "op9_quality_rules")}
    assert len(got) == len(docs)
    for i, t, _ in docs:
        assert all(got[i][k] == v for k, v in brute.quality(t).items())


def test_op10(spark, docs):
    fps = [(i, brute.fingerprint(t)) for i, t, _ in docs]
    want = [(i, f"{fp:016x}", c) for (i, fp), c in zip(fps, brute.hamming_components(fps))]
    assert sorted(tuple(r) for r in rows_of(spark, "op10_simhash")) == want


def test_pipeline(spark, docs, tokenizer):
    """Each stage against a plain restatement on what the stage before kept."""
    frames, df = [], spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = df.columns
    from lexiloom.llm.store import stored

    for name, stage in corpus_pipeline.STAGES:
        df = stored(stage(spark, df, SF_DIR))
        frames.append(df.collect())
        if name != "packing":
            assert df.columns == columns
    good, once, apart, mixed, packed = frames
    verdicts = {r.doc_id: r.kept for r in quality_rules.judge(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()}
    assert {r.doc_id for r in good} == {i for i, kept in verdicts.items() if kept}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall())
    words = {i: len(brute.WORD.findall(t or "")) for i, t, _ in docs}
    assert all(verdicts[i] for i, q in labels.items() if q == 1 and words[i] >= 50)
    best = defaultdict(int)
    for r in good:
        best[r.text] = max(best[r.text], r.doc_id)
    assert sorted(r.doc_id for r in once) == sorted(best.values())
    fps = [(r.doc_id, brute.fingerprint(r.text)) for r in once]
    assert sorted(r.doc_id for r in apart) == sorted(set(brute.hamming_components(fps)))
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= {r.doc_id for r in apart} and max(copies.values()) <= 2
    sizes = Counter()
    for r in apart:
        sizes[r.source] += words[r.doc_id]
    want, taken = brute.targets(sizes), Counter()
    for r in mixed:
        taken[r.source] += words[r.doc_id]
    assert all(abs(taken[s] - want[s]) <= 0.1 * want[s] + 30 for s in sizes)
    ids = {r.doc_id: brute.token_ids(tokenizer, r.text) for r in apart}
    assert sum(r.length for r in packed) == sum(len(ids[i]) * n for i, n in copies.items())
    assert all(brute.crc(ids[r.doc_id][r.start : r.start + r.length]) == r.ids_crc32 for r in packed)
    assert len({r.sequence_id for r in packed}) == len(packed)


def test_run_is_the_registered_pipeline(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    assert QUERIES["pipeline"](spark, SF_DIR).count() > 0
