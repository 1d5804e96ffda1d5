"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the places where personal data can be: at-signs,
schemes, plus signs, digits and identifier cues. A local parser for each anchor
expands it to its boundaries and validates what it found. Parsers look at their
own neighbourhood only and move forward, so a text costs time in proportion to
its length.

Kinds, in this order. The first four follow fixed grammars, leftmost and without
overlaps per kind, and what fails validation is dropped without a retry:

    email    local part before an at-sign, and a host of two or more labels after it
    ip       four dotted numbers of at most 255
    card     16 to 19 digits with single blanks or dashes between them, Luhn
    phone    a plus sign and 8 to 15 digits with blanks, dots, brackets or dashes
    userinfo user and password between a scheme and an at-sign
    iban     an account number of 15 to 34 characters that passes mod 97, after its cue
    account  6 to 20 digits after a cue such as "account no."
    ssn      ddd-dd-dddd after its cue, with no impossible group

Defined results: a null text counts as empty; a text without findings has zero
counts and an empty span list. Rows are scanned one by one, so repeated rows get
equal results. Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexiloom.llm.anchors import automaton
from lexiloom.llm.store import empty_if_null, map_arrow, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "userinfo", "iban", "account", "ssn")
#: Found in an ASCII-lowered copy of the text; "account" covers "account no." and the like, as _after_cue passes over the rest.
ACCOUNT_CUES = ("account", "acct")
SSN_CUES = ("ssn", "social security")
CUES = (
    ("@", "at"),
    ("+", "plus"),
    ("://", "scheme"),
    *((d, "digit") for d in "0123456789"),
    ("iban", "iban"),
    *((c, "account") for c in ACCOUNT_CUES),
    *((c, "ssn") for c in SSN_CUES),
)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_host = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_dotted = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_grouped = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_dialled = re.compile(r"[0-9][\x20().0-9-]*")
_userinfo = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+:[A-Za-z0-9._~%!$&'()*+,;=-]+(?=@)")
_after_cue = re.compile(r"(?:[\x20.:#=]|no|number)*", re.ASCII | re.IGNORECASE)
_iban = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_digits = re.compile(r"[0-9]{6,20}(?![0-9])")
_ssn = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ascii_lower(text: str) -> str:
    """Lower-case ASCII letters, all other code points kept in their places."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of everything found, by kind as listed and then start."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_end = dotted_end = grouped_end = 0
    done = dict.fromkeys(("userinfo", "iban", "account", "ssn"), 0)
    for last, (kind, size) in automaton(CUES).iter(ascii_lower(text)):
        at = last - size + 1
        if kind == "digit":
            if at >= dotted_end:
                chain = _dotted.match(text, at)
                dotted_end = chain.end()
                _addresses(text, at, dotted_end, spans["ip"])
            if at >= grouped_end:
                grouped_end = _grouped.match(text, at).end()
                digits = text[at:grouped_end].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans["card"].append((at, grouped_end))
        elif kind == "at":
            if at < email_end:
                continue
            begin = at
            while begin > email_end and text[begin - 1] in LOCAL:
                begin -= 1
            host = _host.match(text, at + 1) if begin < at else None
            if host:
                email_end = host.end()
                spans["email"].append((begin, email_end))
        elif kind == "plus":
            number = _dialled.match(text, at + 1)
            if number:
                end = number.end()
                while text[end - 1] not in "0123456789":
                    end -= 1
                if end - at >= 4 and 8 <= sum(c in "0123456789" for c in text[at + 1 : end]) <= 15:
                    spans["phone"].append((at, end))
        elif last + 1 >= done.get(name := "userinfo" if kind == "scheme" else kind, 0):
            found = _cued(text, last + 1, name)
            if found:
                spans[name].append(found)
                done[name] = found[1]
    return [(k, a, b) for k in KINDS for a, b in spans[k]]


def _addresses(text: str, begin: int, end: int, out: list[tuple[int, int]]) -> None:
    """Four by four numbers of a maximal chain of dotted numbers."""
    parts = text[begin:end].split(".")
    at = begin
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        stop = at + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
            out.append((at, stop))
        at = stop + 1


def _cued(text: str, at: int, kind: str) -> tuple[int, int] | None:
    if kind == "userinfo":
        m = _userinfo.match(text, at)
        return m.span() if m else None
    at = _after_cue.match(text, at).end()
    if kind == "iban":
        m = _iban.match(text, at)
        while m:  # the longest prefix that passes the check; at most 34 characters
            account = m.group().replace(" ", "")
            if mod97(account):
                return m.span()
            m = _iban.match(text, at, m.end() - 1)
        return None
    m = (_ssn if kind == "ssn" else _digits).match(text, at)
    if m and kind == "ssn" and (m[1] in ("000", "666") or m[1][0] == "9" or m[2] == "00" or m[3] == "0000"):
        return None
    return m.span() if m else None


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts of the base kinds, their digest, and all spans."""
    rows = docs.select(F.col(id_col).alias("id"), empty_if_null(F.col(text_col)).alias("text"))
    kind = rows.schema["id"].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [find(t) for t in batch.column("text").to_pylist()]
            base = [[s for s in f if s[0] in BASE_KINDS] for f in found]
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in BASE_KINDS]
            digests = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(arrow), *counts, digests, pa.array([written(f) for f in found])], names
            )

    names = [id_col, *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans"]
    schema = f"`{id_col}` {kind.simpleString()}, " + ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string"
    return map_arrow(rows, run, schema)
