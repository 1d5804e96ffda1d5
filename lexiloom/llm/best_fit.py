"""Best-fit packing planned over a histogram of lengths.

1. Documents are encoded where they lie. Those of more than ``window`` tokens are
   cut into pieces of ``window``; the last piece may be shorter. Only the pieces'
   small descriptions are written, each with its place ``nth`` among the pieces of
   equal length that its task cut.
2. The histogram (pieces per length) has at most ``window`` rows, whatever the size
   of the corpus. Best fit, longest first, is worked out on it alone: a *range* of
   sequences that are filled alike is one entry, and a length takes whole ranges at
   a time (``plan_slots``).
3. Every piece gets its rank among the pieces of its length: ``nth`` plus the number
   of such pieces that earlier tasks cut. The plan says which ranks of a length sit
   in which range, so each piece finds its sequence and offset by its rank alone.

The plan is small, and provably so. A range that takes a length ``l`` takes as many
as fit, which at least halves the room left in it, so a range is filled at most
``log2(window) + 1`` times; and a length splits at most two ranges. So there are at
most ``3 * window + 1`` ranges and ``(log2(window) + 2)`` times as many entries:
about 170,000 at a window of 4,096, sent to every task.

Sequence numbers run from 0 without gaps.

Defined results: a null text counts as empty and still has its end id, so every row
has at least one piece. Very long texts give many pieces, all but the last full.
Repeated rows are packed separately. Ids may be null; extra columns are ignored,
whatever their names; an empty table gives no pieces. Which of the pieces of equal
length sits where follows the order in which the tasks read them.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexiloom.llm.store import empty_if_null, map_arrow, slices, stored
from lexiloom.llm.words import TEXT_BYTES, WordEncoder
from lexiloom.operators.skew import lookup_join

WINDOW = 4096


def plan_slots(histogram: Mapping[int, int], window: int = WINDOW) -> np.ndarray:
    """Slots for ``histogram`` (length to number of pieces), in order of (length, rank).

    A row is (length, rank, sequence, per, offset): pieces of this length from this
    rank on lie in the sequences from ``sequence`` on, ``per`` in each, the first of
    them at ``offset``; up to the rank of the next row.
    """
    # Ranges of sequences alike by the room left in them: (first sequence, how many).
    open_ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms = np.zeros(window + 1, bool)  # rooms that some range has
    slots, sequences = [], 0

    def fill(first: int, many: int, room: int, length: int, per: int, rank: int) -> int:
        """``per`` pieces into each of ``many`` sequences; the rank after them."""
        slots.append((length, rank, first, per, window - room))
        left = room - per * length
        open_ranges[left].append((first, many))
        rooms[left] = True
        return rank + per * many

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= window:
            raise ValueError(f"length {length} is outside of 1 to {window}")
        rank, left = 0, histogram[length]
        while rank < left:
            # The least room that holds the length; a range just filled has less.
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = length + int(fits[0])
                first, many = open_ranges[room].pop()
                if not open_ranges[room]:
                    rooms[room] = False
            else:
                room, first, many = window, sequences, -(-(left - rank) // (window // length))
                sequences += many
            per = room // length
            full = min(many, (left - rank) // per)
            if full:
                rank = fill(first, full, room, length, per, rank)
            if full < many and left > rank:  # one sequence takes the rest
                rank = fill(first + full, 1, room, length, left - rank, rank)
                full += 1
            if full < many:
                open_ranges[room].append((first + full, many - full))
                rooms[room] = True
    return np.array(sorted(slots), np.int64).reshape(-1, 5)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, part, nth; with
    ``with_ids`` also its ids as little-endian unsigned 32-bit bytes.

    ``part`` is the task that cut the piece and ``nth`` its place among that task's
    pieces of equal length.
    """
    rows = docs.select(F.col(id_col).alias("id"), empty_if_null(F.col(text_col)).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = WordEncoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64).tolist()
        for batch in slices(batches, "text", TEXT_BYTES):
            ids, ends = words.encode(batch.column("text"))
            view, base, out = memoryview(ids.astype("<u4").view(np.uint8)), 0, []
            for doc, end in zip(batch.column("id").to_pylist(), ends.tolist()):
                for piece, start in enumerate(range(base, end, window)):
                    length = min(window, end - start)
                    own = view[4 * start : 4 * (start + length)]
                    nth = seen[length]
                    seen[length] = nth + 1
                    out.append((doc, piece, start - base, length, zlib.crc32(own), part, nth, *([bytes(own)] if with_ids else [])))
                base = end
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    id_type = rows.schema["id"].dataType
    names = ["id", "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * with_ids
    types = [to_arrow_type(id_type), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()] + [pa.binary()] * with_ids
    schema = f"id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return map_arrow(rows, cut, schema + ", ids binary" * with_ids)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, id_col: str = "doc_id", **how) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: id, piece, start, length, ids_crc32,
    sequence_id, offset, and ``ids`` on request (``with_ids=True``)."""
    cut = stored(pieces(docs, tokenizer, window, id_col, **how))
    counts = stored(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    # At most ``window`` rows come to the driver.
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    slots = plan_slots({r["length"]: r["n"] for r in lengths}, window)
    # Pieces of a length that earlier tasks cut; a window holds a row per task.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    ranked = lookup_join(cut, stored(first), ["length", "part"], "inner", spread=["nth"])
    keep = [c for c in ["id", "piece", "start", "length", "ids_crc32", "ids"] if c in cut.columns]
    ranked = ranked.select(*keep, (F.col("first") + F.col("nth")).alias("rank"))
    return _seated(ranked, slots).withColumnRenamed("id", id_col)


RANK_BITS = 44  # pieces of one length are fewer than 2**44; lengths are fewer than 2**19


def _seated(ranked: DataFrame, slots: np.ndarray) -> DataFrame:
    """Every piece in the slot of its length that holds its rank."""
    names = [c for c in ranked.columns if c != "rank"]
    # In order of (length, rank), so a piece's slot is the last that does not lie behind it.
    plan = ranked.sparkSession.sparkContext.broadcast(((slots[:, 0] << RANK_BITS) | slots[:, 1], slots[:, 1:]))

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, (ranks, sequences, pers, offsets) = plan.value[0], plan.value[1].T
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(begins, (length << RANK_BITS) | rank, "right") - 1
            among = rank - ranks[at]
            columns = [
                *[batch.column(c) for c in names],
                pa.array(sequences[at] + among // pers[at]),
                pa.array(offsets[at] + among % pers[at] * length),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in names)
    return map_arrow(ranked, seat, f"{kinds}, sequence_id long, offset long")
