"""Best-fit packing and the alignment of two tokenizers, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry_module
from lexiloom.llm import alignment, best_fit, words
from tests.llm import brute
from tests.llm.data import awkward, empty, frame

SF_DIR = "/root/testdata/sf0.001"
ROWS = awkward()
VOCABULARY = words.tokenizer_path("word_bpe_49k.json")
A_PATH, B_PATH = words.tokenizer_path("byte_bpe_50k.json"), words.tokenizer_path("piece_bpe_32k.model")
QUERIES = entry_module.queries()


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


# best-fit packing


def bins_of_best_fit(histogram, window):
    """Best fit, longest first, item by item."""
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fitting = [r for r in rooms if r >= length]
            if fitting:
                rooms[rooms.index(min(fitting))] -= length
            else:
                rooms.append(window - length)
    return len(rooms)


def seats(slots, histogram):
    """sequence -> (offset, length) of every piece, by rank within length."""
    out = defaultdict(list)
    for length, n in histogram.items():
        mine = slots[slots[:, 0] == length]
        for rank in range(n):
            _, begin, sequence, per, offset = mine[np.searchsorted(mine[:, 1], rank, "right") - 1].tolist()
            out[sequence + (rank - begin) // per].append((offset + (rank - begin) % per * length, length))
    return out


def gapless(sequence, window):
    at = 0
    for offset, length in sorted(sequence):
        assert offset == at
        at += length
    assert at <= window


def test_plan_is_best_fit():
    rng = random.Random(1)
    for _ in range(400):
        window, share = rng.choice([1, 8, 16, 64, 100]), rng.choice([0.1, 0.5, 0.9])
        histogram = {n: rng.randint(1, 30) for n in range(1, window + 1) if rng.random() < share}
        found = seats(best_fit.plan_slots(histogram, window), histogram)
        assert sorted(found) == list(range(len(found)))
        assert len(found) == bins_of_best_fit(histogram, window)
        for sequence in found.values():
            gapless(sequence, window)
    with pytest.raises(ValueError):
        best_fit.plan_slots({9: 1}, 8)


def test_plan_is_small_whatever_the_counts():
    rng = random.Random(2)
    for top in (1, 3, 12):
        histogram = {n: rng.randint(1, 10**top) for n in range(1, 4097)}
        slots = best_fit.plan_slots(histogram)
        assert len(slots) <= 13 * (3 * 4096 + 1)
        used = int(max(s + 0 for s in slots[:, 2]))
        assert used * 4096 <= 1.01 * sum(n * c for n, c in histogram.items()) + 4096 * 4096


def check_packing(got, docs, tokenizer, window):
    want, sequences = Counter(), defaultdict(list)
    for i, t in docs:
        ids = brute.token_ids(tokenizer, t)
        for piece, start in enumerate(range(0, len(ids), window)):
            own = ids[start : start + window]
            want[i, piece, start, len(own), brute.crc(own)] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for sequence in sequences.values():
        gapless(sequence, window)
    lengths = Counter(r.length for r in got)
    assert len(sequences) == (bins_of_best_fit(lengths, window) if got else 0)


@pytest.mark.parametrize("window", [64, 4096])
def test_packing_of_awkward_rows(spark, tokenizer, window):
    got = best_fit.pack(frame(spark, ROWS).repartition(3), VOCABULARY, window, with_ids=True).collect()
    assert all(brute.crc(np.frombuffer(r.ids, "<u4").tolist()) == r.ids_crc32 for r in got)
    check_packing(got, [(i, t) for i, t, _ in ROWS], tokenizer, window)


def test_packing_of_an_empty_table(spark):
    out = best_fit.pack(empty(spark), VOCABULARY)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() == 0


def test_op11(spark, tokenizer):
    check_packing(QUERIES["op11_best_fit"](spark, SF_DIR).collect(), documents(), tokenizer, 4096)


# alignment


@pytest.fixture(scope="module")
def both():
    return alignment.alphabets(A_PATH, B_PATH)


def spans(ids, spelling):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(spelling[i]), i))
        at = out[-1][1]
    return out


def spellings(both):
    """Bytes of both vocabularies, stated anew."""
    base = {c: b for b, c in ((b, chr(b)) for b in (*range(33, 127), *range(161, 173), *range(174, 256)))}
    rest = (b for b in range(256) if b not in base.values())
    base |= {chr(256 + k): b for k, b in enumerate(list(rest))}
    a = {i: bytes(base[c] for c in t) for t, i in both.a.get_vocab(with_added_tokens=False).items()}
    b = {}
    for i in range(both.b.get_piece_size()):
        piece = both.b.id_to_piece(i)
        b[i] = bytes.fromhex(piece[3:5]) if both.b.is_byte(i) else piece.replace("▁", " ").encode()
    return a, b


def brute_alignment(both, texts):
    """Per text (n_a, n_b, n_groups, groups, links), from whole texts."""
    a_bytes, b_bytes = spellings(both)
    out = []
    for text in texts:
        a = both.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b, source = both.b.encode(text or ""), (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != source or b"".join(b_bytes[i] for i in b) != source:
            out.append((0, 0, 0, "", Counter()))
            continue
        a, b = spans(a, a_bytes), spans(b, b_bytes)
        groups, links, lo, i, j = [], Counter(), 0, 0, 0
        for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            mine = [s for s in a[i:i + end - lo] if s[1] <= end], [s for s in b[j:j + end - lo] if s[1] <= end]
            i, j, lo = i + len(mine[0]), j + len(mine[1]), end
            groups.append("|".join(",".join(str(s[2]) for s in side) for side in mine))
            links.update((x[2], y[2]) for x in mine[0] for y in mine[1] if x[0] < y[1] and y[0] < x[1])
        out.append((len(a), len(b), len(groups), ";".join(groups), links))
    return out


def check_alignment(got, docs, both):
    aligned = brute_alignment(both, [t for _, t in docs])
    total, top = sum((x[4] for x in aligned), Counter()), Counter()
    for (_, j), n in total.items():
        top[j] = max(top[j], n)
    want = Counter()
    for (i, _), (n_a, n_b, n_groups, text, links) in zip(docs, aligned):
        best = sum(n for p, n in links.items() if total[p] == top[p[1]])
        sums = best, sum(n * total[p] for p, n in links.items())
        want[i, n_a, n_b, n_groups, sum(links.values()), *sums, hashlib.sha256(text.encode()).hexdigest() if text else ""] += 1
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r[c] for c in names) for r in got) == want
    return total, top


ODD = [
    " ", "  ", "a", "a ", " a", "a  b", "x \ny  \n z", "line\nof\n\ntext\n", "▁x y", "tab\tx\x01y z\x01", "日本語 text é",
    "<|endoftext|> <s> </s> <0x41>", "it's  we'll 'S x's", "é İ. x́", "a\x00b", "n°5 ½ × ÷ ÿ", "😀😀 x", "\nbegins", "\n", "a\r\nb c",
]


def test_chunks_equal_whole_texts(spark, both):
    rng = random.Random(4)
    pool = list("abc éÀ.,' \n\t 12") + ["the ", " 日", "▁", "\x01", "  ", "\n"]
    texts = ODD + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(pa.table({"doc_id": [i for i, _ in docs], "text": texts}).to_pandas())
    check_alignment(alignment.align(df, A_PATH, B_PATH)[0].collect(), docs, both)


def test_alignment_of_awkward_rows(spark, both, monkeypatch):
    rows = [*ROWS, *((1000 + i, t, None) for i, t in enumerate(ODD))]
    out, pairs = alignment.align(frame(spark, rows).repartition(3), A_PATH, B_PATH)
    total, top = check_alignment(out.collect(), [(i, t) for i, t, _ in rows], both)
    found = {(r.a, r.b): (r["count"], r.best) for r in pairs.collect()}
    assert found == {p: (n, n == top[p[1]]) for p, n in total.items()}


def test_identity_map(both):
    a_bytes, b_bytes = spellings(both)
    assert all(a_bytes[a] == b_bytes[b] for a, b in enumerate(both.image.tolist()) if b >= 0)
    assert {a_bytes[a] for a in np.flatnonzero(both.image < 0).tolist()}.isdisjoint(b_bytes.values())


def test_alignment_of_an_empty_table(spark):
    out, pairs = alignment.align(empty(spark), A_PATH, B_PATH)
    assert out.count() == 0 and pairs.count() == 0


def test_op12(spark, both):
    check_alignment(QUERIES["op12_alignment"](spark, SF_DIR).collect(), documents(), both)


def test_chunks_are_aligned_in_parts(monkeypatch):
    import public_tokenizers

    from lexiloom.llm import alignment as A

    both = A.alphabets(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts = pa.array(["plain words, and more of them", "größer 漢字 \u2581 x", "", "a\x01b c", "word " * 40, "x" * 90])
    _, _, chunks, plain = A.split_chunks(texts)
    whole = A.Chunks(chunks, plain, both)
    monkeypatch.setattr(A, "PART", 20)
    assert len(list(A._parts(chunks))) > 3
    parts = A.Chunks(chunks, plain, both)
    for name in ("good", "n_a", "n_b", "n_groups", "n_links", "keys", "regular"):
        assert getattr(parts, name).tolist() == getattr(whole, name).tolist()
        assert getattr(parts, name).dtype == getattr(whole, name).dtype
    assert parts.groups == whole.groups
    assert A.Chunks([], np.zeros(0, bool), both).groups == []


def test_alignment_rows_are_small(spark, both, monkeypatch):
    """A block is cut into rows of bounded size, and Python gets batches no larger than a block."""
    name, limits = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, write = spark.conf.get(name), alignment.stored
    monkeypatch.setattr(alignment, "stored", lambda df, *a: limits.append(int(spark.conf.get(name).rstrip("b"))) or write(df, *a))
    long = " ".join(f"{i:x} wörd{i * 7919 % 10007}," for i in range(60_000))
    rows = spark.createDataFrame([(1, long), (2, "a b"), (3, None), (None, long)], "doc_id long, text string").repartition(1)
    blocks = alignment._blocks(rows, A_PATH, B_PATH, "doc_id", "text")
    names = ["chunks", "links", "linked", "keys"]
    sizes = blocks.selectExpr(*[f"max({'size' if c == 'keys' else 'length'}({c})) AS {c}" for c in names]).first()
    assert max(sizes[:3]) <= 1 << 16 and sizes["keys"] <= 1 << 13
    check_alignment(alignment.align(rows, A_PATH, B_PATH)[0].collect(), [(1, long), (2, "a b"), (3, None), (None, long)], both)
    assert limits[0] <= 4 << 20 and spark.conf.get(name) == before
