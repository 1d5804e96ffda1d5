"""SQL fragments shared by the DuckDB forms of the queries."""

from __future__ import annotations

from lexiloom.functions.text import PUNCTUATION

# The white space classes of functions/text.py in RE2 notation.
WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
QA_WS = r"[ \t\r\n\x{202f}]"
PUNCT_LITERAL = PUNCTUATION.replace("'", "''")


def split_on(expr: str, space: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{space}+'), lambda t: t <> '')"


def tok(expr: str) -> str:
    return split_on(expr, WS)


def qa_tok(expr: str) -> str:
    return split_on(expr, QA_WS)


def normalized_tokens(expr: str) -> str:
    bare = f"translate(lower({expr}), '{PUNCT_LITERAL}', '')"
    return f"list_filter({tok(bare)}, lambda t: t NOT IN ('a', 'an', 'the'))"


def normalized(expr: str) -> str:
    return f"array_to_string({normalized_tokens(expr)}, ' ')"


def stripped(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def token_stream(source: str, key: str, text: str = "text") -> str:
    """Rows (key, pos, term) of a table's text."""
    return (
        f"SELECT {key}, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos "
        f"FROM (SELECT {key}, {tok(text)} AS toks FROM {source})"
    )
