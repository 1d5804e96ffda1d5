"""Tokenising, normalising and tag helpers on string columns."""

from __future__ import annotations

import string
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.arrays import bind, running_sum

# The characters a Python str.split() treats as white space.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# The separators of the question-answering readers.
QA_SPACE = r"[ \t\r\n\u202f]"
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# ASCII punctuation, and the 100 printable characters.
PUNCTUATION = string.punctuation
ALPHABET = string.printable


def tokens(col: Column) -> Column:
    """Split on runs of Unicode white space; no empty tokens."""
    spaced = F.translate(col, _SPACES, " " * len(_SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def strip(col: Column) -> Column:
    """Drop leading and trailing Unicode white space."""
    return F.regexp_replace(col, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def chars(col: Column) -> Column:
    """The characters of a string, one array entry per code point."""
    return F.regexp_extract_all(col, F.lit("(?s)."), 0)


def qa_tokens(col: Column) -> Column:
    """Split on space, tab, CR, LF and U+202F only."""
    return F.array_remove(F.split(col, QA_SPACE + "+"), "")


def char_to_token(col: Column) -> Column:
    """For each character the index of its token; white space belongs to the
    token before it, -1 at the start of the text."""
    runs = F.transform(_pieces(col), lambda p, i: F.array_repeat(i, F.length(p)))
    return F.concat(F.array_repeat(F.lit(-1), _lead(col)), F.flatten(runs))


def _pieces(col: Column) -> Column:
    """Each token with the separators after it."""
    return F.regexp_extract_all(col, F.lit(f"[^{QA_SPACE[1:-1]}]+{QA_SPACE}*"), 0)


def _lead(col: Column) -> Column:
    return F.length(F.regexp_extract(col, f"^{QA_SPACE}*", 0))


def token_at(col: Column, offset: Column) -> Column:
    """Token index of the character at 0-based ``offset``: the tokens that have
    started up to it, less one."""
    return F.size(qa_tokens(F.substring(col, F.lit(1), offset + 1))) - 1


def token_starts(col: Column) -> Column:
    """Character offset of the first character of each token."""
    return bind(
        F.struct(_lead(col).alias("lead"), F.transform(_pieces(col), lambda p: F.length(p)).alias("len")),
        lambda v: F.transform(
            running_sum(v["len"]), lambda e, i: v["lead"] + e - F.element_at(v["len"], i + 1)
        ),
    )


def normalize_answer(col: Column) -> Column:
    """Lower case, no ASCII punctuation, no articles, single spaces; in this order."""
    bare = F.translate(F.lower(col), PUNCTUATION, "")
    return F.array_join(tokens(F.regexp_replace(bare, r"(?U)\b(a|an|the)\b", " ")), " ")


def is_markup(token: Column) -> Column:
    """True for a token that starts with a tag."""
    return token.rlike(r"\A<[^>]+>")


def drop_markup_tokens(arr: Column) -> Column:
    """The tokens that do not start with a tag."""
    return F.filter(arr, lambda t: ~is_markup(t))


def markup_before(arr: Column) -> Column:
    """For each token the number of markup tokens before it."""
    flags = F.transform(arr, lambda t: is_markup(t).cast("int"))
    return bind(
        flags,
        lambda f: F.transform(running_sum(f), lambda n, i: n - F.element_at(f, i + 1)),
    )


def count_markup_before(arr: Column, index: Column) -> Column:
    """Number of markup tokens before one 0-based index."""
    return F.size(F.filter(F.slice(arr, 1, F.greatest(index, F.lit(0))), is_markup))


def semichar_entries(token: Column) -> Column:
    """The non-zero semi-character features as (ix, n), in index order.

    Three blocks over the printable alphabet: first character, interior
    character counts, last character. Characters outside the alphabet are left
    out; see ``unknown_chars``.
    """
    width = len(ALPHABET)

    def edge(char: Column, offset: int) -> Column:
        at = F.instr(F.lit(ALPHABET), char)
        return F.when(
            (at > 0) & (char != ""), F.array(F.struct((at - 1 + offset).alias("ix"), F.lit(1).alias("n")))
        ).otherwise(F.array().cast("array<struct<ix:int,n:int>>"))

    inner = F.substring(token, F.lit(2), F.greatest(F.length(token) - 2, F.lit(0)))
    places = F.filter(F.transform(chars(inner), lambda c: F.instr(F.lit(ALPHABET), c)), lambda i: i > 0)
    counts = bind(
        places,
        lambda ps: F.transform(
            F.array_sort(F.array_distinct(ps)),
            lambda i: F.struct((i - 1 + width).alias("ix"), F.size(F.filter(ps, lambda p: p == i)).alias("n")),
        ),
    )
    return F.concat(edge(F.substring(token, 1, 1), 0), counts, edge(F.substring(token, -1, 1), 2 * width))


def semichar_features(token: Column) -> Column:
    """The semi-character features as a dense array of 300 values."""
    width = 3 * len(ALPHABET)
    return F.aggregate(
        semichar_entries(token),
        F.array_repeat(F.lit(0.0), width),
        lambda v, e: F.concat(
            F.slice(v, F.lit(1), e["ix"]),
            F.array(e["n"].cast("double")),
            F.slice(v, e["ix"] + 2, width - 1 - e["ix"]),
        ),
    )


def unknown_chars(token: Column) -> Column:
    """Number of characters outside the printable alphabet."""
    return F.length(F.translate(token, ALPHABET, ""))


def noisy_token(token: Column, action: Column, index: Column, drop_tail: bool = False) -> Column:
    """Keep (action 0), drop (1) or swap with the next (2) the character at the
    0-based interior ``index`` of tokens with three or more characters.

    ``drop_tail`` gives the published swap, which loses what follows.
    """
    head = F.substring(token, F.lit(1), index)
    char = F.substring(token, index + 1, F.lit(1))
    following = F.substring(token, index + 2, F.lit(1))
    dropped = F.concat(head, F.substring(token, index + 2, F.length(token)))
    tail = F.lit("") if drop_tail else F.substring(token, index + 3, F.length(token))
    swapped = F.concat(head, following, char, tail)
    return (
        F.when(F.length(token) < 3, token).when(action == 1, dropped).when(action == 2, swapped).otherwise(token)
    )


def join_wordpieces(arr: Column) -> Column:
    """Glue word pieces: join with spaces, remove the piece markers, tidy spaces."""
    glued = F.replace(F.replace(F.array_join(arr, " "), F.lit(" ##"), F.lit("")), F.lit("##"), F.lit(""))
    return F.array_join(tokens(glued), " ")


def until_eos(col: Column, eos: str = "<EOS>") -> Column:
    """Stripped text up to the end mark."""
    return F.substring_index(strip(col), eos, 1)


def split_tag(tag: Column) -> Column:
    """``O`` gives (O, null), ``B-NP`` gives (B, NP); anything else is an error."""
    parts = F.split(tag, "-", 2)
    bad = F.raise_error(F.concat(F.lit("tag without a type: "), tag)).cast("string")
    return F.struct(
        F.when(tag == "O", "O").otherwise(F.get(parts, 0)).alias("prefix"),
        F.when(tag == "O", None).when(F.size(parts) == 2, F.get(parts, 1)).otherwise(bad).alias("type"),
    )


def _accent_table() -> tuple[str, str]:
    """Letters and their base letters under canonical decomposition, followed by
    the combining marks, which have no counterpart and are dropped."""
    letters, bases, marks = [], [], []
    for code in range(0x80, 0x10000):
        c = chr(code)
        if unicodedata.category(c) == "Mn":
            marks.append(c)
            continue
        kept = [x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn"]
        if len(kept) == 1 and kept[0] != c:
            letters.append(c)
            bases.append(kept[0])
    return "".join(letters + marks), "".join(bases)


_ACCENTED, _BASES = _accent_table()
# ASCII symbols that count as punctuation besides the Unicode class P.
_SYMBOLS = r"$+<=>^`|~"
# The code ranges of Chinese characters, which become one token each.
_CJK = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)


def basic_tokens(col: Column, lower: bool = True) -> Column:
    """Tokens of a reader model before subwords: control characters removed,
    lower case without accents, punctuation and Chinese characters alone.

    Accents are taken off letter by letter; Hangul syllables stay whole.
    """
    clean = F.regexp_replace(col, r"[\p{Cc}\p{Cf}\x{FFFD}&&[^\t\n\r]]", "")
    spaced = F.regexp_replace(clean, f"([{_CJK}])", " $1 ")
    if lower:
        spaced = F.translate(F.lower(spaced), _ACCENTED, _BASES)
    return tokens(F.regexp_replace(spaced, r"([\p{P}" + _SYMBOLS + "])", " $1 "))


def project_to_source_text(pred: Column, orig: Column, lower: bool = True) -> Column:
    """The part of ``orig`` that the normalised ``pred`` stands for.

    ``pred`` is looked up in the tokenised ``orig`` and its first and last
    character are carried over by counting the characters that are not spaces.
    On any mismatch the answer is ``orig`` itself. An equal ``pred`` gives ``orig`` either
    way and is not looked up.
    """

    def ink(text: Column) -> Column:
        return F.length(F.replace(text, F.lit(" "), F.lit("")))

    def carry(tok: Column) -> Column:
        at = F.instr(tok, pred)
        places = F.filter(
            F.transform(chars(orig), lambda c, i: F.when(c != " ", i + 1)), lambda p: p.isNotNull()
        )
        usable = (F.length(pred) > 0) & (at > 0) & (ink(tok) == ink(orig))
        edges = (F.substring(pred, 1, 1) != " ") & (F.substring(pred, -1, 1) != " ")
        before = ink(F.substring(tok, F.lit(1), at - 1))
        span = bind(
            F.struct(places.alias("p"), before.alias("b")),
            lambda v: bind(
                F.struct(
                    F.get(v["p"], v["b"]).alias("s"), F.get(v["p"], v["b"] + ink(pred) - 1).alias("e")
                ),
                lambda w: F.substring(orig, w["s"], w["e"] - w["s"] + 1),
            ),
        )
        return F.when(usable & edges, span).otherwise(orig)

    return F.when(pred == orig, orig).otherwise(bind(F.array_join(basic_tokens(orig, lower), " "), carry))
