"""Secrets: candidates of every text, judged by who else holds the same value.

A scan finds candidate spans and writes one small row per document. The digest
of each candidate's value is then counted over the whole corpus: in how many
repositories and by how many owners it occurs. Values that several owners hold
are copied examples; a value of a single owner that looks random is live-looking.
Counting goes through distinct (value, repository, owner) rows, so a value that a
third of all documents share is one row per task before it is shuffled, and the
join of the verdicts to the candidates deals hot values over many tasks.

Kinds: the first three follow fixed grammars, leftmost and without overlaps per
kind, and what fails is dropped without a retry:

    assign   a keyword, an assignment sign and a value of 12 or more characters
    access   AKIA and upper case letters or digits, 18 or more characters
    hex      16 or more lower case hexadecimal digits
    pem      the header line of a private key
    jwt      three dotted base64url parts, the first two JSON objects

``live`` repeats the span of a candidate that the ownership counts call
live-looking.

Defined results: a null text counts as empty; a text without candidates has zero
counts and no spans. A null repository or owner is one of its own. Ids may be null
or repeat: rows are told apart by their place in the scan. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexiloom.llm.store import empty_if_null, map_arrow, slices, stored
from lexiloom.operators.skew import spread_join

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "jwt")
MAX_OWNERS = 1  # more owners than this make a value a copied example
MIN_BITS = 3.0  # bits per character from which a value looks random

_assign = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_access = re.compile(r"AKIA[A-Z0-9]{14,}")
_hex = re.compile(r"[0-9a-f]{16,}")
_pem = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
_jwt = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then kind as listed."""
    found = [("assign", *m.span(), m[1]) for m in _assign.finditer(text) if len(m[1]) >= 12]
    for kind, pattern in (("access", _access), ("hex", _hex), ("pem", _pem), ("jwt", _jwt)):
        found += [(kind, *m.span(), m[0]) for m in pattern.finditer(text)]
    return sorted(found, key=lambda c: (c[1], KINDS.index(c[0])))


def bits_per_char(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def extract(docs: DataFrame, id_col: str, repo_col: str, owner_col: str, text_col: str) -> DataFrame:
    """One row per document: id, repo, owner, counts, base digest, and its candidates."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(repo_col).cast("string").alias("repo"),
        F.col(owner_col).cast("string").alias("owner"),
        empty_if_null(F.col(text_col)).alias("text"),
    )
    kind = rows.schema["id"].dataType
    arrow = to_arrow_type(kind)
    entry = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary()), ("bits", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [candidates(t) for t in batch.column("text").to_pylist()]
            base = [[c for c in f if c[0] in BASE_KINDS] for f in found]
            counts = [pa.array([sum(c[0] == k for c in b) for b in base], pa.int64()) for k in BASE_KINDS]
            digests = [hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b, _ in f).encode()).hexdigest() for f in base]
            # values leave the task as digests only
            entries = [
                [{"kind": k, "start": a, "end": b, "value": hashlib.sha256(v.encode()).digest()[:16], "bits": bits_per_char(v)} for k, a, b, v in f]
                for f in found
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(arrow), batch.column("repo").cast(pa.string()), batch.column("owner").cast(pa.string()), *counts, pa.array(digests), pa.array(entries, pa.list_(entry))], names
            )

    names = ["id", "repo", "owner", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "found"]
    schema = (
        f"id {kind.simpleString()}, repo string, owner string, "
        + ", ".join(f"n_{k} long" for k in BASE_KINDS)
        + ", base_sha256 string, found array<struct<kind:string,start:long,end:long,value:binary,bits:double>>"
    )
    return map_arrow(rows, run, schema)


def ownership(candidate_rows: DataFrame) -> DataFrame:
    """(value, n_repos, n_owners) over the corpus, of rows (value, repo, owner)."""
    distinct = candidate_rows.select("value", "repo", "owner").distinct()
    null_safe = lambda c: F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v"))
    repos = distinct.select("value", null_safe("repo").alias("x"), F.lit(1).alias("r")).distinct()
    owners = distinct.select("value", null_safe("owner").alias("x"), F.lit(0).alias("r")).distinct()
    return (
        repos.unionByName(owners)
        .groupBy("value")
        .agg(F.sum("r").cast("bigint").alias("n_repos"), F.sum(1 - F.col("r")).cast("bigint").alias("n_owners"))
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    repo_col: str = "repo",
    owner_col: str = "owner",
    text_col: str = "text",
    max_owners: int = MAX_OWNERS,
    min_bits: float = MIN_BITS,
) -> DataFrame:
    """One row per row of ``docs``: id, counts of the base kinds, their digest, all
    spans, and how many candidates are live-looking or copied examples."""
    rows = stored(extract(docs, id_col, repo_col, owner_col, text_col).withColumn("r", F.monotonically_increasing_id()))
    each = rows.select("r", "repo", "owner", F.explode("found").alias("c")).select("r", "repo", "owner", "c.*")
    counts = stored(ownership(each))
    judged = spread_join(each.drop("repo", "owner"), counts, ["value"], "inner", ["r", "start"]).select(
        "r", "kind", "start", "end",
        (F.col("n_owners") > max_owners).alias("copied"),
        ((F.col("n_owners") <= max_owners) & ((F.col("bits") >= min_bits) | (F.col("kind") == "pem"))).alias("live"),
    )
    order = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "live")]), F.col("kind"))
    live = judged.where("live").withColumn("kind", F.lit("live"))
    spans = (
        judged.unionByName(live)
        .groupBy("r")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", order.alias("o"), F.col("end").alias("e"), F.col("kind").alias("k")))).alias("s"),
            F.count_if((F.col("kind") != "live") & F.col("live")).alias("n_live"),
            F.count_if((F.col("kind") != "live") & F.col("copied")).alias("n_copied"),
        )
        .select("r", F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["k"], x["start"].cast("string"), x["e"].cast("string"))), ",").alias("spans"), "n_live", "n_copied")
    )
    zero = F.lit(0).cast("bigint")
    return rows.drop("found", "repo", "owner").join(spans, "r", "left").select(
        F.col("id").alias(id_col), *[f"n_{k}" for k in BASE_KINDS], "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied"),
    )
