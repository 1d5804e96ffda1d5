"""Repeated passages: bytes covered by a long string that also starts elsewhere.

A string of ``length`` bytes that occurs twice must be found wherever its copies
lie, so equal strings have to meet in one place without sorting all suffixes of
the corpus together:

1. Every window of ``length`` bytes has an anchor, the ``ANCHOR``-gram of least
   hash in it (the first, if there are several). Equal windows have equal
   anchors at equal offsets. Windows in a row mostly share their anchor.
2. Anchors are dealt by hash in packed records. Those that occur once in the
   corpus end there; the places of the others return to their texts, of which
   each distinct one is taken once and those without such places are dropped.
3. For each repeated anchor its context, the bytes of all windows that have it,
   goes to the task of that anchor. Equal contexts settle each other at once. The
   different ones are joined in blocks, and the suffix array of a block brings
   equal windows next to each other.
4. Spans of windows found twice return to their text, are merged and cut out.

The suffix array is built over short chunks, not bytes: a chunk ends after white
space, or after 16 bytes without any, and then with every byte. Where a chunk
begins depends on the 16 bytes before it only, so equal windows are cut alike
from at most 16 bytes after their start. Chunks are numbered in byte order and
none is a prefix of another, so the order of chunk sequences is that of the
bytes. A window is settled at its first certain chunk: some other suffix agrees
with it up to the window's end, and with the few bytes before.

An anchor with more than ``DENSE`` places is not joined into a block. Its contexts
are counted by a 128-bit hash in an ordinary aggregate, which combines before the
shuffle; then, of one place for each different context, the windows are counted in
the same way. Rows grow with the different contexts, never with pairs of places. Texts with exact copies need no search: all their bytes go if
they have ``length`` of them. Frequent copies are removed before any text is
shuffled.

Defined results: a null text counts as empty. Texts shorter than ``length`` keep
all bytes. Repeated rows are exact copies. Ids may be null; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm import exact_dedup
from lexiloom.llm.store import empty_if_null, map_arrow, partitions, slices, stored
from lexiloom.llm.suffix_array import suffix_array
from lexiloom.operators.skew import spread_join

LENGTH = 200
ANCHOR = 48
CHUNK = 16
DENSE = 16384
BLOCK_BYTES = 1 << 20
SEGMENT = 4 << 20  # a longer text is searched in segments of so many windows
RECORDS = 2_000_000  # anchor records held before singles and hot anchors are looked for
HOT = np.uint32(1 << 31)
RECORD = np.dtype([("h", "<u8"), ("key", "<u8"), ("at", "<u4")])
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * _A + (b ^ (b >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``ANCHOR`` (48) bytes at every position of ``data``."""
    n = len(data)
    if n < ANCHOR:
        return np.zeros(0, np.uint64)
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    eight = np.ascontiguousarray(eight).view(np.uint64).ravel()
    h16 = _mix(eight[:-8], eight[8:])
    h32 = _mix(h16[:-16], h16[16:])
    return _mix(h32[: n - ANCHOR + 1], h16[32 : 32 + n - ANCHOR + 1])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(doc, at, lo, hi, h) of the anchors of texts joined in ``data``.

    ``at`` is the anchor's position, ``lo`` to ``hi`` the starts of the windows
    that have it; all count from the beginning of ``data``.
    """
    none = np.zeros(0, np.int64)
    h = gram_hashes(data)
    span = length - ANCHOR + 1
    count = len(h) - span + 1
    if count <= 0:
        return none, none, none, none, np.zeros(0, np.uint64)
    low = np.uint64((1 << 24) - 1)
    out = []
    for base in range(0, count, SEGMENT):
        stop = min(base + SEGMENT, count)
        part = h[base : stop + span - 1]
        key = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        pad = -len(key) % span
        rows = np.append(key, np.full(pad, np.iinfo(np.uint64).max)).reshape(-1, span)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: stop - base], ahead[span - 1 : span - 1 + stop - base])
        at = (least & low).astype(np.int64) + base
        start = np.arange(base, stop)
        doc = np.searchsorted(offsets, start, side="right") - 1
        inside = start + length <= offsets[doc + 1]
        start, at, doc = start[inside], at[inside], doc[inside]
        if len(start):
            new = np.flatnonzero((at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)) + 1
            first, last = np.append(0, new), np.append(new, len(start)) - 1
            out.append((doc[first], at[first], start[first], start[last], h[at[first]]))
    return tuple(map(np.concatenate, zip(*out))) if out else (none, none, none, none, np.zeros(0, np.uint64))


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column, and where each value begins."""
    values = [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int64)
    return np.frombuffer(b"".join(values), np.uint8), offsets


def _anchor_records(buckets: int, length: int):
    """Packed anchor records of texts: rows (bucket, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            data, offsets = _joined(batch.column("text"))
            doc, at, _, _, h = anchors(data, offsets, length)
            records = np.empty(len(h), RECORD)
            records["h"], records["at"] = h, at - offsets[doc]
            records["key"] = batch.column("key").to_numpy().view(np.uint64)[doc]
            bucket = (h >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            records, bucket = records[order], bucket[order]
            cuts = np.append(0, np.flatnonzero(np.diff(bucket.astype(np.int64))) + 1) if len(h) else np.zeros(0, np.int64)
            ends = np.append(cuts[1:], len(h))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts].astype(np.int32)), pa.array([records[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())],
                ["bucket", "records"],
            )

    return run


def _repeated(dense: int):
    """Places of anchors that occur at two places or more: rows (key, places), the
    top bit of a place marking anchors of more than ``dense`` places.

    Holds the records of anchors that are not hot; those of hot ones pass through.
    """

    def places(found: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
        at = found["at"] | np.where(hot, HOT, np.uint32(0))
        order = np.argsort(found["key"], kind="stable")
        key, at = found["key"][order], at[order]
        cuts = np.append(0, np.flatnonzero(key[1:] != key[:-1]) + 1) if len(key) else np.zeros(0, np.int64)
        ends = np.append(cuts[1:], len(key))
        return pa.RecordBatch.from_arrays(
            [pa.array(key[cuts].view(np.int64)), pa.array([at[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())], ["key", "places"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh, waiting = np.empty(0, RECORD), [], 0
        hot_anchors = np.empty(0, np.uint64)

        def gather():
            records = np.concatenate([held, *fresh])
            # copies of a text give equal records; one is enough
            records = records[np.lexsort((records["at"], records["key"], records["h"]))]
            same = np.zeros(len(records), bool)
            same[1:] = records[1:] == records[:-1]
            records = records[~same]
            names, start, count = np.unique(records["h"], return_index=True, return_counts=True)
            return records, names, np.repeat(count, count)

        for batch in batches:
            for value in batch.column("records").to_pylist():
                fresh.append(np.frombuffer(value, RECORD))
                waiting += len(fresh[-1])
            if waiting >= RECORDS:
                records, names, count = gather()
                is_hot = (count > dense) | np.isin(records["h"], hot_anchors)
                if is_hot.any():
                    yield places(records[is_hot], np.ones(int(is_hot.sum()), bool))
                    hot_anchors = np.union1d(hot_anchors, records["h"][is_hot])
                held, fresh, waiting = records[~is_hot], [], 0
        records, names, count = gather()
        is_hot = (count > dense) | np.isin(records["h"], hot_anchors)
        keep = is_hot | (count > 1)
        yield places(records[keep], is_hot[keep])

    return run


def _with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge rows sorted by (key, kind), places before texts: every distinct text of
    a key that has places, once, with them."""
    key, places, done = None, [], set()
    for batch in batches:
        keys, kinds = batch.column("key").to_pylist(), batch.column("kind").to_pylist()
        out = []
        for i, (k, kind) in enumerate(zip(keys, kinds)):
            if k != key:
                key, places, done = k, [], set()
            if kind == 0:
                places.append(batch.column("places")[i].as_py())
            elif places:
                digest = batch.column("d")[i].as_py()
                if digest not in done:
                    done.add(digest)
                    out.append((digest, batch.column("text")[i].as_py(), b"".join(places)))
        digests, texts, found = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.array(texts, pa.string()), pa.array(found, pa.binary())], ["d", "text", "places"]
        )


def _chosen(batch: pa.RecordBatch, hot: bool, length: int):
    """Anchors of the batch's texts whose places are marked hot, or are not."""
    data, offsets = _joined(batch.column("text"))
    doc, at, lo, hi, h = anchors(data, offsets, length)
    wanted = []
    for i, places in enumerate(batch.column("places").to_pylist()):
        places = np.frombuffer(places, np.uint32)
        wanted.append((places[(places & HOT != 0) == hot] & ~HOT).astype(np.int64) + offsets[i])
    keep = np.isin(at, np.concatenate(wanted)) if wanted else np.zeros(0, bool)
    return data, offsets, doc[keep], lo[keep], hi[keep], h[keep]


def _contexts(length: int):
    """Rows (h, context, rid, lo): the bytes of all windows of an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets, doc, lo, hi, h = _chosen(batch, False, length)
            raw = data.tobytes()
            rid = batch.column("rid").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)),
                    pa.array([raw[a : b + length] for a, b in zip(lo.tolist(), hi.tolist())], pa.binary()),
                    pa.array(rid[doc] if len(doc) else np.zeros(0, np.int64)),
                    pa.array(lo - offsets[doc] if len(doc) else np.zeros(0, np.int64)),
                ],
                ["h", "context", "rid", "lo"],
            )

    return run


def _digests(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit hashes of pieces of ``raw``, as two columns."""
    found = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())]
    return np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)


def _hot_contexts(length: int):
    """Rows (a, b, rid, lo, n): hash, place and windows of every context of a hot anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets, doc, lo, hi, _ = _chosen(batch, True, length)
            pairs = _digests(data.tobytes(), lo, hi + length)
            rid = batch.column("rid").to_numpy()[doc] if len(doc) else np.zeros(0, np.int64)
            columns = (pairs[:, 0], pairs[:, 1], rid, lo - offsets[doc] if len(doc) else lo, hi - lo + 1)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "rid", "lo", "n"])

    return run


def _hot_windows(length: int):
    """Rows (a, b, rid, lo): hash and place of every window of the contexts ``chosen``
    (lo, n) of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for text, rid, chosen in zip(*(batch.column(c).to_pylist() for c in ("text", "rid", "chosen"))):
                raw = text.encode()
                for begin in range(0, len(chosen), 256):  # bounded output batches
                    starts = np.concatenate([np.arange(c["lo"], c["lo"] + c["n"]) for c in chosen[begin : begin + 256]])
                    pairs = _digests(raw, starts, starts + length)
                    columns = (pairs[:, 0], pairs[:, 1], np.full(len(starts), rid), starts)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "rid", "lo"])

    return run


def _hot_spans(texts: DataFrame, length: int) -> DataFrame:
    """Spans (rid, begin, end) of the repeated windows of hot anchors."""

    def twice(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(one place of every different hash, hashes with two places or more)."""
        place = F.struct("rid", "lo")
        found = stored(rows.groupBy("a", "b").agg(F.min(place).alias("x"), F.max(place).alias("y"), F.min("n").alias("n")))
        return found.select("x.*", "n"), found.where("x <> y").select("a", "b")

    def spans(rows: DataFrame, repeated: DataFrame) -> DataFrame:
        both = spread_join(rows, repeated, ["a", "b"], "left_semi", ["rid", "lo"])
        return both.select("rid", F.col("lo").alias("begin"), (F.col("lo") + F.col("n") - 1 + length).alias("end"))

    contexts = stored(map_arrow(texts, _hot_contexts(length), "a long, b long, rid long, lo long, n long"))
    one_each, repeated = twice(contexts)
    chosen = one_each.groupBy("rid").agg(F.collect_list(F.struct("lo", "n")).alias("chosen"))
    windows = map_arrow(texts.select("rid", "text").join(chosen, "rid"), _hot_windows(length), "a long, b long, rid long, lo long")
    windows = stored(windows).withColumn("n", F.lit(1).cast("bigint"))
    return spans(contexts, repeated).unionByName(spans(windows, twice(windows)[1]))


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def repeated_windows(contexts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(context, start) of every window of the contexts that also starts elsewhere in them."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(contexts)), sizes)
    begin = (ends - sizes)[owner]
    here = np.arange(len(data)) - begin  # position in the own context
    space = SPACE[data]
    seen = np.append(0, np.cumsum(space))
    after_space = np.zeros(len(data), bool)
    after_space[1:] = space[:-1]
    after_space &= here > 0
    index = np.arange(len(data))
    no_space = (here >= CHUNK) & (seen[index] == seen[np.maximum(index - CHUNK, 0)])
    cut = after_space | no_space | (here == 0)
    at = np.flatnonzero(cut)
    stop = np.minimum(np.append(at[1:], len(data)), ends[owner[at]])
    # chunks as two big-endian numbers, padded with zeros, and whether a chunk follows white space
    padded = np.append(data, np.zeros(2 * CHUNK, np.uint8))
    rows = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[at].copy()
    rows[np.arange(CHUNK) >= (stop - at)[:, None]] = 0
    halves = rows.view(">u8").astype(np.uint64)
    kind = no_space[at].astype(np.int64)
    order = np.lexsort((halves[:, 1], halves[:, 0], kind))
    sorted_rows = np.column_stack((kind[order].astype(np.uint64), halves[order]))
    rank = np.empty(len(at), np.int64)
    rank[order] = np.cumsum(np.append(0, (sorted_rows[1:] != sorted_rows[:-1]).any(axis=1))) + 2
    opens = here[at] == 0
    rank[opens] = 1  # the first chunk of a context may be cut short: it is only a border
    ordered = suffix_array(rank)
    place = at[ordered]
    room = ends[owner[place]] - place  # bytes to the end of the context
    place = place[~opens[ordered] & (room >= length - CHUNK)]
    if len(place) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    common = _common(padded, place, np.minimum(ends[owner[place]] - place, length), length)
    # the bytes before a chunk, latest first
    behind = np.lib.stride_tricks.sliding_window_view(np.append(np.zeros(CHUNK, np.uint8), data), CHUNK)[place][:, ::-1]
    behind = np.ascontiguousarray(behind)
    spaces = SPACE[behind]
    offset = here[place]
    found = []
    for back in range(1, CHUNK + 1):
        if back < CHUNK:  # certain at the first white space after the window's start
            fits = after_space[place] & ~spaces[:, 1:back].any(axis=1)
        else:
            fits = np.where(after_space[place], ~spaces[:, 1:CHUNK].any(axis=1), True)
        fits &= (offset >= back) & (ends[owner[place]] - place >= length - back)
        run = np.append(0, np.cumsum(common < length - back))
        mine = np.flatnonzero(fits)
        if len(mine) < 2:
            continue
        tail = behind[mine].copy()
        tail[:, back:] = 0
        tail = tail.view(np.uint64)
        by = np.lexsort((tail[:, 1], tail[:, 0], run[mine]))
        same = (run[mine][by][1:] == run[mine][by][:-1]) & (tail[by][1:] == tail[by][:-1]).all(axis=1)
        hit = np.append(same, False) | np.append(False, same)
        found.append(place[mine[by[hit]]] - back)
    starts = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return owner[starts], here[starts]


def _common(padded: np.ndarray, place: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """Equal leading bytes of neighbours in ``place``, at most ``length`` and inside both contexts."""
    padded = np.append(padded, np.zeros(length, np.uint8))
    view = np.lib.stride_tricks.sliding_window_view(padded, length)
    out = np.empty(len(place) - 1, np.int64)
    for begin in range(0, len(out), 1 << 14):
        a = place[begin : begin + (1 << 14) + 1]
        rows = view[a]
        differ = rows[1:] != rows[:-1]
        out[begin : begin + len(a) - 1] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    return np.minimum(out, np.minimum(room[1:], room[:-1]))


def _spans(rid: np.ndarray, lo: np.ndarray, which: np.ndarray, start: np.ndarray, length: int):
    """(rid, begin, end) of runs of neighbouring windows."""
    if not len(which):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((start, which))
    which, start = which[order], start[order]
    new = np.flatnonzero((which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    first, last = np.append(0, new), np.append(new, len(which)) - 1
    base = lo[which[first]]
    return rid[which[first]], base + start[first], base + start[last] + length


def _blocks(block_bytes: int, length: int):
    """Spans (rid, begin, end) from contexts sorted by (h, context)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rid, begin, end):
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (rid, begin, end)], ["rid", "begin", "end"])

        def settle(block):
            texts, rids, los = zip(*block)
            which, start = repeated_windows(list(texts), length)
            return emit(*_spans(np.array(rids), np.array(los), which, start, length))

        block, own, size, own_size = [], [], 0, 0  # closed anchors, and the different contexts of the open one
        anchor = context = first = None
        settled = []  # spans of equal contexts

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("h", "context", "rid", "lo"))
            for h, c, rid, lo in zip(*columns):
                if h != anchor:
                    if len(own) > 1:
                        block, size = block + own, size + own_size
                    own, own_size, anchor, context = [], 0, h, None
                    if size >= block_bytes:
                        yield settle(block)
                        block, size = [], 0
                if c != context:
                    context, first = c, (rid, lo)
                    own.append((c, rid, lo))
                    own_size += len(c)
                else:  # the same bytes at another place
                    if first is not None:
                        settled.append((*first, len(c)))
                        first = None
                    settled.append((rid, lo, len(c)))
            if settled:
                rid, lo, n = map(np.array, zip(*settled))
                yield emit(rid, lo, lo + n)
                settled = []
        if len(own) > 1:
            block = block + own
        if block:
            yield settle(block)

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of texts with their spans."""
    for batch in slices(batches, "text"):
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            raw, kept, at, removed, runs = text.encode(), hashlib.sha256(), 0, 0, 0
            end = -1
            for a, b in sorted((s["begin"], s["end"]) for s in spans):
                if a > end:
                    kept.update(raw[at:a])
                    runs += 1
                    removed += b - a
                    at = end = b
                elif b > end:
                    removed += b - end
                    at = end = b
            kept.update(raw[at:])
            rows.append((removed, runs, kept.hexdigest()))
        removed, runs, digests = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("d").cast(pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string())],
            ["d", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_spans(
    docs: DataFrame, text_col: str = "text", length: int = LENGTH, dense: int = DENSE, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): distinct texts that may repeat something, as (rid, d, text), and
    the spans (rid, begin, end) of their repeated windows, in bytes."""
    if length < ANCHOR + CHUNK:
        raise ValueError(f"length must be {ANCHOR + CHUNK} or more")
    n = partitions(docs)
    text = empty_if_null(F.col(text_col))
    rows = docs.select(text.alias("text"), exact_dedup.digest(F.col(text_col)).alias("d"))
    key = F.conv(F.substring(F.hex("d"), 1, 15), 16, 10).cast("bigint")
    rows = rows.select("text", "d", key.alias("key")).where(F.octet_length("text") >= length)
    records = map_arrow(rows.select("text", "key"), _anchor_records(8 * n, length), "bucket int, records binary")
    places = map_arrow(records.repartition(n, "bucket"), _repeated(dense), "key long, places binary")
    nothing = lambda kind: F.lit(None).cast(kind)
    merged = (
        places.select("key", F.lit(0).alias("kind"), nothing("string").alias("text"), nothing("binary").alias("d"), "places")
        .unionByName(rows.select("key", F.lit(1).alias("kind"), "text", "d", nothing("binary").alias("places")))
        .repartition(n, "key")
        .sortWithinPartitions("key", "kind")
    )
    texts = stored(
        map_arrow(merged, _with_places, "d binary, text string, places binary").withColumn("rid", F.monotonically_increasing_id())
    )
    contexts = map_arrow(texts, _contexts(length), "h long, context binary, rid long, lo long")
    cold = map_arrow(
        contexts.repartition(n, "h").sortWithinPartitions("h", "context"), _blocks(block_bytes, length), "rid long, begin long, end long"
    )
    return texts, cold.unionByName(_hot_spans(texts, length))


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    dense: int = DENSE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256."""
    size = F.octet_length(empty_if_null(F.col(text_col))).cast("bigint")
    classes, winners = exact_dedup.classes_and_winners(docs, id_col, text_col, also={"n_bytes": size})
    classes = stored(classes)
    once = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), exact_dedup.digest(F.col(text_col)).alias("d")).join(
        F.broadcast(winners.select("d", F.col("top.id").alias("keep"))), "d", "left"
    ).where(F.col("keep").isNull() | F.col("id").eqNullSafe(F.col("keep")))
    texts, spans = repeated_spans(once.select("text"), "text", length, dense, block_bytes)
    spans = spans.groupBy("rid").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    cut = map_arrow(
        texts.select("rid", "d", "text").join(spans, "rid").select("d", "text", "spans"), _cut_out,
        "d binary, n_removed long, n_spans long, kept_sha256 string",
    ).select(F.lower(F.hex("d")).alias("t"), "n_removed", "n_spans", "kept_sha256")
    columns = [F.col(id_col), F.col("n_bytes")]
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    copied = classes.where("group_size > 1").select(
        *columns,
        F.when(F.col("n_bytes") >= length, F.col("n_bytes")).otherwise(zero).alias("n_removed"),
        F.when(F.col("n_bytes") >= length, one).otherwise(zero).alias("n_spans"),
        F.when(F.col("n_bytes") >= length, F.sha2(F.lit(""), 256)).otherwise(F.col("text_sha256")).alias("kept_sha256"),
    )
    single = classes.where("group_size = 1").join(cut, F.col("text_sha256") == F.col("t"), "left").select(
        *columns,
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "text_sha256").alias("kept_sha256"),
    )
    return single.unionByName(copied)
