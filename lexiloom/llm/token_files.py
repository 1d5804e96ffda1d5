"""Token ids in files of 64-bit words: Simple-8b with escapes and block offsets.

Format. The files are Parquet, one row per block of whole documents, uncompressed
so that a block can be mapped as it is:

    part, nth      place of the block: blocks in order of (part, nth) hold the
                   documents in ascending id
    first, ids     number of ids of the part before this block, and in it
    docs, lengths  little-endian 64-bit: lengths (in ids) of the block's documents,
                   whose ids are the list ``docs``
    words          little-endian 64-bit words
    starts         little-endian 32-bit: word at which each run of ``RUN`` ids begins
    escapes        little-endian 64-bit: ids that no word can hold

A word has a selector in its top four bits and equal fields below it, the first
id lowest. Selector s holds ``COUNTS[s]`` ids of ``60 // COUNTS[s]`` bits;
selector 0 stands for the next entry of ``escapes``. Packing begins anew at every
run, so a reader can decode any run alone, and all words of one selector decode
in one vector operation.

Texts are ordered first and encoded after, so that ids are written once and
never shuffled. Ids of all documents before a part come from one row per part.

Defined results: a null text counts as empty and has only the end id. Repeated
rows are repeated. Null ids come first. Extra columns are ignored; an empty table
gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexiloom.llm.store import empty_if_null, map_arrow, partitions, slices
from lexiloom.llm.words import TEXT_BYTES, WordEncoder

COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])  # ids in a word, by selector
ESCAPE = 0
RUN = 4096
BLOCK_IDS = 1 << 17  # a block is closed at the first slice of texts that fills it


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, starts, escapes) of unsigned ids; greedy, as many ids in a word as fit."""
    ids = np.ascontiguousarray(ids)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    choice = _choices(ids)
    begins = _begins(COUNTS[choice], n)
    selector = choice[begins]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector).tolist():
        if s == ESCAPE:
            continue
        count = int(COUNTS[s])
        mine = np.flatnonzero(selector == s)
        for k in range(count):
            words[mine] |= ids[begins[mine] + k].astype(np.uint64) << np.uint64(k * (60 // count))
    starts = np.searchsorted(begins, np.arange(0, n, RUN)).astype(np.uint32)
    return words, starts, ids[begins[selector == ESCAPE]].astype(np.uint64)


def _begins(counts: np.ndarray, n: int) -> np.ndarray:
    """Places at which a word begins. No word crosses runs, so all runs are walked
    at once: step k finds the k-th word of every run that has one."""
    at = np.arange(0, n, RUN)
    ends = np.minimum(at + RUN, n)
    begins = np.zeros(n, bool)
    while len(at):
        begins[at] = True
        at = at + counts[at]
        left = at < ends
        if not left.all():
            at, ends = at[left], ends[left]
    return np.flatnonzero(begins)


def _choices(ids: np.ndarray) -> np.ndarray:
    """For every place the selector that packs most ids into a word that begins there.

    A word of more ids has narrower fields, so it fits only where one of fewer
    fits: each step looks at the places left by the step before.
    """
    n = len(ids)
    place = np.arange(n, dtype=np.int32)
    left = np.minimum(RUN - place % RUN, n - place)  # ids to the end of the run
    largest = int(ids.max())
    choice = np.full(n, ESCAPE, np.int8)
    fits = place  # places where a word of the count before fits
    for s in range(len(COUNTS) - 1, 0, -1):
        count, bits = int(COUNTS[s]), 60 // int(COUNTS[s])
        fits = fits[left[fits] >= count]
        if largest >> bits:
            limit = ids.dtype.type(1 << bits)  # some id is wider, so this fits the type
            if len(fits) > n // 16:
                wide = np.zeros(n + 1, np.int32)
                np.cumsum(ids >= limit, out=wide[1:])
                fits = fits[wide[fits + count] == wide[fits]]
            else:
                for k in range(count):
                    fits = fits[ids[fits + k] < limit]
        choice[fits] = s
    return choice


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of whole words, as unsigned 64-bit numbers."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in np.unique(selector).tolist():
        mine = np.flatnonzero(selector == s)
        first = ends[mine] - counts[mine]
        if s == ESCAPE:
            out[first] = escapes
            continue
        bits = 60 // int(COUNTS[s])
        mask = np.uint64((1 << bits) - 1)
        for k in range(int(COUNTS[s])):
            out[first + k] = words[mine] >> np.uint64(k * bits) & mask
    return out


def unpack_run(words: np.ndarray, starts: np.ndarray, escapes: np.ndarray, run: int) -> np.ndarray:
    """Only the ids of one run, by the block's offsets."""
    lo = int(starts[run])
    hi = int(starts[run + 1]) if run + 1 < len(starts) else len(words)
    before = int((words[:lo] >> np.uint64(60) == ESCAPE).sum())
    own = words[lo:hi]
    return unpack(own, escapes[before : before + int((own >> np.uint64(60) == ESCAPE).sum())])


def write(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None
) -> None:
    """Encode all documents into files below ``path``, in ascending id."""
    rows = docs.select(F.col(id_col).alias("id"), empty_if_null(F.col(text_col)).alias("text"))
    arrow = to_arrow_type(rows.schema["id"].dataType)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = WordEncoder(tokenizer), TaskContext.get().partitionId()
        first = nth = held = 0  # ids before the open block, its number, and ids in it
        docs, lengths, coded = [], [], []

        def block():
            packed, starts, escapes = pack(np.concatenate(coded))
            sizes = np.concatenate(lengths)
            row = [part, nth, first, held, docs, sizes.astype("<i8").tobytes(), packed.astype("<u8").tobytes(), starts.astype("<u4").tobytes(), escapes.astype("<u8").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in slices(batches, "text", TEXT_BYTES):
            ids, ends = words.encode(batch.column("text"))
            docs += batch.column("id").to_pylist()
            lengths.append(np.diff(ends, prepend=0))
            coded.append(ids)
            held += len(ids)
            if held >= BLOCK_IDS:
                yield block()
                first, nth, held, docs, lengths, coded = first + held, nth + 1, 0, [], [], []
        if coded:
            yield block()

    names = ["part", "nth", "first", "ids", "docs", "lengths", "words", "starts", "escapes"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(arrow), *[pa.binary()] * 4]
    kind = rows.schema["id"].dataType.simpleString()
    ordered = rows.repartitionByRange(parts or partitions(docs), "id").sortWithinPartitions("id")
    blocks = map_arrow(
        ordered, encode,
        f"part int, nth int, first long, ids long, docs array<{kind}>, lengths binary, words binary, starts binary, escapes binary",
    )
    blocks.write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str, id_name: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document from the files: id, start, n_tokens, ids_crc32, and the ids on request."""
    blocks = spark.read.parquet(path)
    # One row per part, as many as write tasks.
    parts = blocks.groupBy("part").agg(F.sum("ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    kind = blocks.schema["docs"].dataType.elementType
    arrow = to_arrow_type(kind)
    placed = blocks.join(F.broadcast(offsets), "part").select(
        (F.col("before") + F.col("first")).alias("start"), "docs", "lengths", "words", "escapes"
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, docs, lengths, words, escapes = (batch.column(c)[i].as_py() for c in range(5))
                lengths = np.frombuffer(lengths, "<i8")
                ids = unpack(np.frombuffer(words, "<u8"), np.frombuffer(escapes, "<u8")).astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                begins = ends - lengths
                view = memoryview(ids)
                own = [view[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist())]
                columns = [pa.array(docs, arrow), pa.array(start + begins), pa.array(lengths), pa.array([zlib.crc32(o) for o in own], pa.int64())]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(o, "<u4").astype(np.int64) for o in own], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, [id_name, "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    schema = f"`{id_name}` {kind.simpleString()}, start long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * with_ids
    return map_arrow(placed, decode, schema)

