"""Packing without padding: documents cut into pieces of binary length.

The token count of a document is written in binary: as many pieces of the full
window as fit, then one piece for every set bit of the rest, longest first. All
lengths are powers of two, and pieces of equal length form a bucket. A piece is a
sequence of its own, so no sequence crosses documents and none needs padding.

Documents are encoded where they lie. Only the pieces' small descriptions are
written, once, to number the sequences: bucket after bucket, gapless, by
counting the pieces of every (length, part) and adding offsets.

Defined results: a null text counts as empty and still has its end id, so every
row has at least one piece. Repeated rows are packed separately. Ids may be
null; extra columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexiloom.llm.store import empty_if_null, map_arrow, slices, stored
from lexiloom.llm.words import TEXT_BYTES, WordEncoder

WINDOW = 2048


def binary_pieces(n: int, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    start = 0
    for _ in range(n // window):
        yield start, window
        start += window
    bit = window >> 1
    while bit:
        if n & bit:
            yield start, bit
            start += bit
        bit >>= 1


def pieces(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, part, nth; with
    ``with_ids`` also its ids as little-endian unsigned 32-bit bytes.

    ``part`` is the task that cut the piece and ``nth`` its place among that
    task's pieces of equal length.
    """
    if window & (window - 1) or window < 1:
        raise ValueError("the window must be a power of two")
    rows = docs.select(F.col(id_col).alias("id"), empty_if_null(F.col(text_col)).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, seen = WordEncoder(tokenizer), TaskContext.get().partitionId(), {}
        for batch in slices(batches, "text", TEXT_BYTES):
            ids, ends = words.encode(batch.column("text"))
            view, base, out = memoryview(ids.astype("<u4").view(np.uint8)), 0, []
            for doc, end in zip(batch.column("id").to_pylist(), ends.tolist()):
                n = end - base
                for start, length in binary_pieces(n, window):
                    own = view[4 * (base + start) : 4 * (base + start + length)]
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    out.append((doc, start, length, zlib.crc32(own), n, part, nth, *([bytes(own)] if with_ids else [])))
                base = end
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    id_type = rows.schema["id"].dataType
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"] + ["ids"] * with_ids
    types = [to_arrow_type(id_type), *[pa.int64()] * 4, pa.int32(), pa.int64()] + [pa.binary()] * with_ids
    schema = f"id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"
    return map_arrow(rows, cut, schema + ", ids binary" * with_ids)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", **how) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``. Sequence ids run from 0 without
    gaps, shortest bucket first, so a range of ids is a bucket of equal lengths."""
    cut = stored(pieces(docs, tokenizer, id_col=id_col, **how))
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row per length and task: a small table, whatever the size of the texts.
    order = Window.orderBy("length", "part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
    return cut.join(F.broadcast(first), ["length", "part"]).select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
        *[c for c in cut.columns if c == "ids"],
    )
