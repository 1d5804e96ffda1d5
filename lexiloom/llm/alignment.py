"""Alignment of two tokenizers over a corpus, with a fast path for identical tokens.

Every text, with a space before it, is cut by tokenizer A (byte-level BPE) and by
tokenizer B (pieces with byte fallback). Byte offsets at which tokens of both end cut
the text into *groups*; an A and a B token whose bytes overlap are *linked*. An id
pair's count is the number of links of the whole corpus that hold it.

* Both tokenizers end a token before a space or line end that follows another character,
  so a text is a row of *chunks*, each such a sign and what follows up to the next, that
  are cut independently. A block of texts encodes and aligns each different chunk once;
  a text is a list of chunk numbers.
* Identity map: an array from A id to the B id of the same bytes. One-to-one groups of
  an A id and its image, the regular case, are counted in a vector as long as A's
  vocabulary, one per task. Only the pairs of all other groups enter the shuffle: each
  block sends a pair once, with its number, so a pair that is everywhere has one row per
  block at most.
* The totals go back the same way. Those of the identity map are vectors again (sent to
  every task; their size is A's vocabulary); those of other pairs are joined to the
  blocks that asked for them, and each block works out the sums of its texts.

Defined results: a text that is null or empty, or whose tokens of A or B do not give the
bytes of the text back (B writes a space for U+2581, say), has no tokens: all numbers are
zero and the groups an empty string. Very long texts are blocks of their own. Repeated
rows count again and give repeated rows. Ids may be null; extra columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexiloom.llm.store import LARGE_ROWS, batch_bytes, empty_if_null, map_arrow, slices, stored, trim

BLOCK_BYTES = 4 << 20  # text whose different chunks are encoded together
JOINED = 1 << 16  # characters of chunks sent to a tokenizer at once
PIECE = 1 << 16  # bytes of a block's column in a row: the JVM gives arrays of half a megabyte whole regions of its heap
PART = 1 << 18  # characters of chunks aligned at once: the arrays in between grow with it, not with the block
# Latin letters and signs, which are of one kind in any version of Unicode.
_RE2_LATIN = r"!-~\x{c0}-\x{ff}"
CUT = "\x01"  # marks chunks while a text is split


class Alphabets:
    """Both tokenizers, the bytes of their tokens, and the identity map."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        vocabulary = json.loads(self.a.to_str())["model"]["vocab"]
        letters = _letter_bytes()
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(letters[c] for c in token)
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            whole = self.b.is_unknown(i) or self.b.is_control(i)
            b_bytes.append(b"" if whole else bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.n_b = len(b_bytes)
        self.a_bytes, self.b_bytes = _Spelling(a_bytes), _Spelling(b_bytes)
        # Where a byte has a piece of its own and a fallback piece, the plain piece is the image.
        image = {t: i for i, t in enumerate(b_bytes) if self.b.is_byte(i)}
        image |= {t: i for i, t in enumerate(b_bytes) if t and not self.b.is_byte(i)}
        self.image = np.array([image.get(t, -1) for t in a_bytes], np.int64)
        self.space = self.b.piece_to_id("▁")
        self.fast = self._fast_a(vocabulary)

    def _fast_a(self, vocabulary: dict[str, int]):
        """The same merges in tiktoken, which encodes plain Latin text faster."""
        import public_tokenizers
        import tiktoken

        letters = _letter_bytes()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_plain(self, text: str) -> tuple[list[int], list[int]]:
        """A and B ids of chunks of Latin signs in a row."""
        return self.fast.encode_ordinary(text), self._b(text)

    def encode_any(self, chunk: str) -> tuple[list[int], list[int]]:
        return self.a.encode(chunk, add_special_tokens=False).ids, self._b(chunk)

    def _b(self, chunk: str) -> list[int]:
        """B adds a space by itself, a token of its own before a line end; nothing to an empty text."""
        if chunk[:1] == " ":
            return self.b.encode(chunk[1:]) if len(chunk) > 1 else [self.space]
        return self.b.encode(chunk)[1:]


class _Spelling:
    """The bytes of all tokens of a vocabulary, laid end to end."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[ids] - first, sizes) + np.arange(int(sizes.sum()))
        return self.pool[at].tobytes()


def _letter_bytes() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256 and on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def alphabets(a_path: str, b_path: str) -> Alphabets:
    return Alphabets(a_path, b_path)


class Chunks:
    """Different chunks of a block, encoded and aligned.

    ``good``      whether the tokens of both give the bytes of the chunk back
    ``n_a``, ``n_b``, ``n_groups``, ``n_links``   numbers per chunk
    ``keys``      the linked pairs of chunk after chunk: A id * size of B + B id
    ``regular``   which of them are a one-to-one group of an id and its image
    ``groups``    the groups of each chunk, written out
    """

    def __init__(self, chunks: list[str], plain: np.ndarray, both: Alphabets):
        parts = [_Part(chunks[lo:hi], plain[lo:hi], both) for lo, hi in _parts(chunks)] or [_Part([], plain, both)]
        for name in ("good", "n_a", "n_b", "n_groups", "n_links", "keys", "regular"):
            setattr(self, name, np.concatenate([getattr(p, name) for p in parts]))
        self.groups = [g for p in parts for g in p.groups]


class _Part:
    """Neighbouring chunks, with what ``Chunks`` says of them."""

    def __init__(self, chunks: list[str], plain: np.ndarray, both: Alphabets):
        raw = [c.encode() for c in chunks]
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        self.good = np.ones(len(chunks), bool)
        a_parts, b_parts = [], []
        for lo, hi in _runs(chunks, plain):
            source = b"".join(raw[lo:hi])
            if plain[lo]:
                a, b = (np.array(ids, np.int64) for ids in both.encode_plain("".join(chunks[lo:hi])))
                if both.a_bytes.spell(a) != source or both.b_bytes.spell(b) != source:
                    raise AssertionError("plain Latin text is not given back")  # both models hold every such letter or its bytes
            else:
                a, b = (np.array(ids, np.int64) for ids in both.encode_any(chunks[lo]))
                if both.a_bytes.spell(a) != source or both.b_bytes.spell(b) != source:
                    self.good[lo] = False
                    a = b = np.zeros(0, np.int64)
            a_parts.append(a)
            b_parts.append(b)
        # A chunk without tokens takes no room in the coordinates below.
        sizes = np.where(self.good, np.diff(ends, prepend=0), 0)
        self._align(np.concatenate([*a_parts, []]).astype(np.int64), np.concatenate([*b_parts, []]).astype(np.int64), np.cumsum(sizes), both)

    def _align(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray, both: Alphabets) -> None:
        """All chunks in one row of bytes: tokens, groups and links are cuts of it."""
        a_ends, b_ends = np.cumsum(both.a_bytes.sizes[a]), np.cumsum(both.b_bytes.sizes[b])
        # Between two neighbouring ends lies one A and one B token: a link.
        cuts = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")  # two runs in order
        cuts = cuts[np.append(True, cuts[1:] != cuts[:-1])[: len(cuts)]]
        in_a, in_b = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        together = (a_ends[in_a] == cuts) & (b_ends[in_b] == cuts)  # both end here: a group ends
        group_ends = cuts[together]
        # Chunk of every end, and how many there are in each chunk.
        filled = np.flatnonzero(np.diff(ends, prepend=0))
        chunk_ends = ends[filled]

        def per_chunk(places: np.ndarray) -> np.ndarray:
            out = np.zeros(len(ends), np.int64)
            out[filled] = np.diff(np.searchsorted(places, chunk_ends, "right"), prepend=0)
            return out

        self.n_a, self.n_b = per_chunk(a_ends), per_chunk(b_ends)
        self.n_groups, self.n_links = per_chunk(group_ends), per_chunk(cuts)
        first = np.append(True, together)[:-1]  # the link begins its group
        self.regular = first & together & (both.image[a[in_a]] == b[in_b])
        self.keys = (a[in_a] * both.n_b + b[in_b]).astype(np.int32)
        self.groups = _written(a, b, a_ends, b_ends, group_ends, chunk_ends, filled, len(ends))


def _written(a, b, a_ends, b_ends, group_ends, chunk_ends, filled, n) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for every chunk: ids in order, each with the sign that follows it."""
    a_group, b_group = np.searchsorted(group_ends, a_ends), np.searchsorted(group_ends, b_ends)
    order = np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")
    ids = np.concatenate([a, b])[order]
    a_sign = np.where(a_ends == group_ends[a_group], 1, 0) if len(a) else a
    b_sign = np.where(b_ends == group_ends[b_group], np.where(chunk_ends[np.searchsorted(chunk_ends, b_ends)] == b_ends, 3, 2), 0) if len(b) else b
    sign = np.concatenate([a_sign, b_sign])[order].astype(np.int32)
    signs = pa.array([",", "|", ";", "\n"]).take(pa.array(sign))
    text = pc.binary_join_element_wise(pa.array(ids).cast(pa.string()), signs, "").cast(pa.binary())
    lines = b"".join(text.to_numpy(zero_copy_only=False).tolist()).split(b"\n")
    out = [b""] * n
    for i, line in zip(filled.tolist(), lines):
        out[i] = line
    return out


def _parts(chunks: list[str]) -> Iterator[tuple[int, int]]:
    """Neighbouring chunks of ``PART`` characters in all, or one longer chunk."""
    lo, held = 0, 0
    for i, chunk in enumerate(chunks):
        if lo < i and held + len(chunk) > PART:
            yield lo, i
            lo, held = i, 0
        held += len(chunk)
    if lo < len(chunks):
        yield lo, len(chunks)


def _runs(chunks: list[str], plain: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring plain chunks of ``JOINED`` characters in all; any other chunk alone."""
    lo, held = 0, 0
    for i, chunk in enumerate(chunks):
        if lo < i and not (plain[i] and plain[lo] and held < JOINED):
            yield lo, i
            lo, held = i, 0
        held += len(chunk)
    if lo < len(chunks):
        yield lo, len(chunks)


def split_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """(chunks per text, their numbers, the different chunks, which of them are plain)."""
    texts = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))  # a copy without offset
    space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    spaced = pc.binary_join_element_wise(space, texts, nothing)
    marked = pc.replace_substring_regex(spaced, rf"([{_RE2_LATIN}])([ \n])", rf"\1{CUT}\2")
    whole = pc.match_substring(spaced, CUT)  # a text that holds the mark itself is one chunk, put in below
    split = pc.split_pattern(pc.if_else(whole, "", marked), CUT)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(split).dictionary_encode()
    plain = pc.match_substring_regex(flat.dictionary, rf"\A[ \n][{_RE2_LATIN}]+\z").to_numpy(zero_copy_only=False)
    chunks = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
    index = flat.indices.to_numpy(zero_copy_only=False).copy()
    for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
        index[counts[:i].sum()] = len(chunks)
        chunks.append(spaced[i].as_py())
    plain = np.append(plain, np.zeros(len(chunks) - len(plain), bool))
    order = np.argsort(~plain, kind="stable")  # plain ones first, so that they are encoded together
    return counts, np.argsort(order, kind="stable")[index], [chunks[i] for i in order.tolist()], plain[order]


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).

    Documents: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    ``count_sum`` adds the counts of all links; ``n_best`` counts links whose count is
    the highest of their B id. Pairs: a, b, count, best, over the whole corpus.
    """
    both = alphabets(a_path, b_path)
    n_b, image = both.n_b, both.image
    spark = docs.sparkSession
    with batch_bytes(spark, BLOCK_BYTES):
        blocks = stored(_blocks(docs, a_path, b_path, id_col, text_col), LARGE_ROWS)
    sent = blocks.select(F.inline(F.arrays_zip("keys", "counts")))
    totals = stored(sent.groupBy(F.col("keys").alias("key")).agg(F.sum("counts").alias("n")))
    # One row per B id: as many as B's vocabulary at most.
    highest = totals.groupBy((F.col("key") % n_b).alias("b")).agg(F.max("n").alias("top"))
    scored = totals.join(F.broadcast(highest), F.col("key") % n_b == F.col("b")).select("key", "n", (F.col("n") == F.col("top")).alias("best"))
    regular = np.flatnonzero(image >= 0)
    images = pa.table({"key": (regular * n_b + image[regular]).astype(np.int32)})  # as many as A's vocabulary at most
    known = scored.join(F.broadcast(spark.createDataFrame(images)), "key").collect()
    counts, best = np.zeros(len(image), np.int64), np.zeros(len(image), bool)
    for row in known:
        counts[row["key"] // n_b], best[row["key"] // n_b] = row["n"], row["best"]
    vectors = spark.sparkContext.broadcast((counts, best))
    asked = blocks.where("block IS NOT NULL").select(F.col("block").alias("of"), F.explode("keys").alias("key"))
    answers = asked.join(scored.hint("shuffle_hash"), "key")
    kind = blocks.schema["ids"].dataType.elementType
    measured = _measured(blocks.where("block IS NOT NULL").drop("keys", "counts"), answers, vectors, n_b, image, kind)
    pairs = scored.select(
        F.floor(F.col("key") / n_b).cast("int").alias("a"), (F.col("key") % n_b).alias("b"), F.col("n").alias("count"), "best"
    )
    return measured.withColumnRenamed("id", id_col), pairs


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """Blocks of texts: what each text and each different chunk holds, and the irregular
    pairs with their numbers. What is long is cut into the rows of a block, numbered by
    ``piece``; what each text holds is in the first. The last row of a task has no block
    but the regular pairs of all its blocks."""
    rows = docs.select(F.col(id_col).alias("id"), empty_if_null(F.col(text_col)).alias("text"))
    id_type = rows.schema["id"].dataType
    types = [
        pa.int64(), pa.int32(), pa.list_(to_arrow_type(id_type)), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()),
        *[pa.binary()] * 3, pa.list_(pa.int32()), pa.list_(pa.int64()),
    ]
    names = ["block", "piece", "ids", *_NUMBERS, "words", "sha", "chunks", "links", "linked", "keys", "counts"]

    def cut(block: int | None, texts: list, long: list) -> Iterator[pa.RecordBatch]:
        steps = [PIECE] * 3 + [PIECE // 8] * 2
        for piece in range(max(1, *(-(-len(v) // n) for v, n in zip(long, steps)))):
            values = [block, piece, *(texts if piece == 0 else [[]] * len(texts))]
            values += [v[piece * n : (piece + 1) * n] for v, n in zip(long, steps)]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, part = alphabets(a_path, b_path), TaskContext.get().partitionId()
        vector = np.zeros(len(both.image), np.int64)
        for nth, batch in enumerate(slices(batches, "text", BLOCK_BYTES)):
            texts = batch.column("text")
            words, index, distinct, plain = split_chunks(texts)
            chunks = Chunks(distinct, plain, both)
            ends = np.cumsum(words)
            bad = _sums(~chunks.good[index], ends) > 0
            bad |= pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            kept = ~np.repeat(bad, words)
            index, words = index[kept], np.where(bad, 0, words)
            ends = np.cumsum(words)
            times = np.bincount(index, minlength=len(distinct))
            weights = np.repeat(times, chunks.n_links)
            a = chunks.keys // both.n_b
            vector += np.bincount(a[chunks.regular], weights[chunks.regular], len(vector)).astype(np.int64)
            odd = ~chunks.regular & (weights > 0)
            keys, at = np.unique(chunks.keys[odd], return_inverse=True)
            numbers = [_sums(getattr(chunks, c)[index], ends) for c in _NUMBERS]
            linked = np.where(chunks.regular, -chunks.keys - 1, chunks.keys)
            counts = np.bincount(at, weights[odd], len(keys)).astype(np.int64)
            held = [batch.column("id").to_pylist(), *numbers, words, _digests(chunks.groups, index, ends)]
            yield from cut(part << 32 | nth, held, [*(v.astype("<i4").tobytes() for v in (index, chunks.n_links, linked)), keys, counts])
            del batch, texts, chunks, distinct, held
            trim()  # or the worker keeps what a block took in between
        used = np.flatnonzero(vector)
        keys = (used * both.n_b + both.image[used]).astype(np.int32)
        yield from cut(None, [[]] * 7, [b"", b"", b"", keys, vector[used]])

    kind = id_type.simpleString()
    numbers = ", ".join(f"{c} array<long>" for c in [*_NUMBERS, "words"])
    schema = (
        f"block long, piece int, ids array<{kind}>, {numbers}, sha array<string>, chunks binary, links binary, linked binary, "
        "keys array<int>, counts array<long>"
    )
    return map_arrow(rows, encode, schema)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of neighbouring values up to each end."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return np.diff(total[ends], prepend=0)


def _digests(groups: list[bytes], index: np.ndarray, ends: np.ndarray) -> list[str]:
    out, begin, index = [], 0, index.tolist()
    for end in ends.tolist():
        text = b";".join([groups[i] for i in index[begin:end]])
        out.append(hashlib.sha256(text).hexdigest() if end > begin else "")
        begin = end
    return out


def _measured(blocks: DataFrame, answers: DataFrame, vectors, n_b: int, image: np.ndarray, kind) -> DataFrame:
    """The rows of the documents, from the blocks and the totals they asked for."""
    arrow = to_arrow_type(kind)
    names = ["id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"]

    def measure(block: pa.Table, answered: pa.Table) -> pa.Table:
        counts, best = vectors.value
        block = block.sort_by("piece")
        held = block.slice(0, 1).drop_columns(["chunks", "links", "linked"]).to_pylist()[0]
        index, links, linked = (np.frombuffer(b"".join(block[c].to_pylist()), "<i4") for c in ("chunks", "links", "linked"))
        keys = answered["key"].to_numpy()
        order = np.argsort(keys)
        keys, n, top = keys[order], answered["n"].to_numpy()[order], answered["best"].to_numpy()[order]
        regular = linked < 0
        a = (-1 - linked[regular]) // n_b
        score, hit = np.zeros(len(linked), np.int64), np.zeros(len(linked), np.int64)
        score[regular], hit[regular] = counts[a], best[a]
        if len(keys):  # chunks of texts without tokens asked for nothing; nobody reads their sums
            at = np.minimum(np.searchsorted(keys, linked[~regular]), len(keys) - 1)
            score[~regular], hit[~regular] = n[at], top[at]
        chunk_ends, ends = np.cumsum(links), np.cumsum(held["words"], dtype=np.int64)
        columns = [pa.array(held["ids"], arrow), *[pa.array(held[c], pa.int64()) for c in _NUMBERS]]
        columns += [pa.array(_sums(_sums(v, chunk_ends)[index], ends)) for v in (hit, score)]
        return pa.table([*columns, pa.array(held["sha"], pa.string())], names)

    numbers = ", ".join(f"{c} long" for c in names[1:-1])
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("of"))
        .applyInArrow(measure, f"id {kind.simpleString()}, {numbers}, groups_sha256 string")
    )
