"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry_module
from lexiloom.llm import spelling
from tests.llm.data import awkward, empty, frame

SF_DIR = "/root/testdata/sf0.001"


def counted(docs, least=3, every=97):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}


def near_words(words):
    """Near words by trying what is left when one sign is taken out or masked."""
    masked, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masked[w[:i] + "\0" + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in masked.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute_variants(docs, **how):
    words = counted(docs, **how)
    near, form = near_words(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return {tuple(r) for r in df.collect()}


def similar(rng, n, letters="abcdeé"):
    """Words in families one or two edits apart, and long ones."""
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(n)}
    words |= {"a" * k for k in (5, 6, 7, 30, 31, 90)} | {"ab" * 40, "ab" * 40 + "a", "b" + "ab" * 40, "ab" * 20 + "c" + "ab" * 20}
    for w in list(words):
        at, c = rng.randrange(len(w)), rng.choice(letters)
        words |= {w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], c + w, w + c}
    return {w for w in words if len(w) >= 5}


@pytest.mark.parametrize("bound", [0, 3, 40, 10**9])
def test_untouched_grams_are_shared(bound):
    """What an edit cannot touch is in the other word, at its place or one further."""
    rng = random.Random(bound)
    words = similar(rng, 150)
    counts = Counter()
    for s in map(spelling.padded, words):
        for size in range(spelling.SHORTEST, spelling.LONGEST + 1):
            counts.update(s[p : p + size] for p in range(len(s) - size + 1))
    frequent = {g: n for g, n in counts.items() if n > bound}
    for w in words:
        s = spelling.padded(w)
        grams = spelling.decompose(s, frequent)
        assert grams[0][0] == 0 and grams[-1][1] == len(s)
        for inserted in (False, True):
            for at in range(5, len(s) - 5 + inserted):
                other = s[:at] + rng.choice("abcdeé") + s[at + (not inserted) :]
                there = spelling.decompose(other, frequent)
                before, behind = spelling.untouched(s, dict(enumerate(grams)), frequent, at, inserted)
                assert all(there[k] == grams[k] for k in before)
                assert all(there[k - len(grams)] == tuple(x + inserted for x in grams[k]) for k in behind)


@pytest.mark.parametrize("bound", [0, 3, 40, 10**9])
def test_keys_meet(bound):
    """Every pair of near words meets in a key, long words in the keys of their ends."""
    words = similar(random.Random(bound + 1), 120)
    counts = Counter()
    for s in map(spelling.padded, words):
        for size in range(spelling.SHORTEST, spelling.LONGEST + 1):
            counts.update(s[p : p + size] for p in range(len(s) - size + 1))
    frequent = {g: n for g, n in counts.items() if n > bound}
    keys = {w: spelling.Keys(w, frequent) for w in words}
    near = near_words(words)
    assert sum(map(len, near.values())) > 500
    for w, others in near.items():
        wanted, single = keys[w].probes()
        assert len(keys[w].index()[0]) <= (2 * spelling.ENDS) ** 2
        for other in others:
            if len(other) >= len(w):
                held, held_single = keys[other].index()
                assert not set(held).isdisjoint(wanted) or not set(held_single).isdisjoint(single), (w, other)


@pytest.mark.parametrize(("rare", "most"), [(0, 10**6), (4, 10**6), (100, 10**6), (0, 50)])
def test_variants_of_similar_words(spark, rare, most):
    rng = random.Random(7)
    words = sorted(similar(rng, 200))
    docs = [(i, " ".join(rng.choice(words) for _ in range(30)) + " " + w * 1) for i, w in enumerate(words * 3)]
    docs += [(-i, (w + " ") * rng.randint(1, 60)) for i, w in enumerate(words[::7])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(spelling.variants(df, rare=rare, most=most)) == brute_variants(docs)


def test_chains_of_forms(spark):
    counts = {"aaaaa": 200, "aaaab": 90, "aaabb": 40, "aabbb": 18, "abbbb": 8, "bbbbb": 3, "bbbbc": 3, "zzzzz": 5}
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows(spelling.variants(df, every=10**12))
    assert got == brute_variants(docs, every=10**12)
    assert ("bbbbb", "abbbb", "aaaaa", 3, 2, 8) in got and ("zzzzz", None, "zzzzz", 5, 0, None) in got


def test_awkward_rows(spark):
    upper = [(900 + i, "STRASSE Straße straSSe ÀÉ×÷ à1b Ärger ärger ÄRGER " * 2, None) for i in range(3)]
    many = [*awkward(), *upper]
    assert rows(spelling.variants(frame(spark, many))) == brute_variants([r[:2] for r in many])


def test_empty_table(spark):
    assert rows(spelling.variants(empty(spark))) == set()


def test_op13(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    want = brute_variants(docs)
    assert rows(entry_module.queries()["op13_spelling"](spark, SF_DIR)) == want and len(want) > 500
