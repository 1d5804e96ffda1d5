"""Token ids of whole texts by a public tokenizer, word by word.

The tokenizer drops white space and never looks across it: normalising,
splitting and merging all happen inside a run of other characters. So the ids of
a text are the ids of its words in a row, and every task encodes a word that it
meets often only once. ``tests/llm`` compares this with encoding whole texts.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
CACHED_WORDS = 400_000  # bound of the words a Python worker remembers
TEXT_BYTES = 4 << 20  # text encoded at once, in which each different word is looked up once
CACHED_BYTES = 48  # longer words are encoded every time


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Lower-case Latin letters, which normalising leaves as they are.
_plain = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: bytes that are not printable Latin-1 stand for 256 and on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


# Letters and digits whose composed and lower-case form is one letter or digit again. Others, such as a
# capital I with a dot, turn into a letter and a mark, which belongs to the comma or stop behind it.
_BEFORE_STOP = r"[A-Za-z0-9\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]"


def _fewer_forms(texts: pa.Array) -> pa.Array:
    """Texts with the same ids but fewer different words: lower-case letters, and a
    comma or stop that ends a word set apart.

    The tokenizer lowers letters itself and splits between a letter or digit and a
    comma or stop. Texts with special tokens, or with marks that may join a letter
    of one case only, are left alone.
    """
    delicate = pc.match_substring_regex(texts, r"<\||\p{M}")
    apart = pc.replace_substring_regex(pc.ascii_lower(texts), rf"({_BEFORE_STOP})([.,])(\s|$)", r"\1 \2\3")
    return pc.if_else(delicate, texts, apart)


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer of a Python worker; it is kept for later tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Words that the last task of this Python worker met lately, at most half of ``CACHED_WORDS``.
_lately: dict[str, dict[str, bytes]] = {}


class WordEncoder:
    """Encodes the texts of one task; half of the words it remembers pass to the next."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        # words of the running half and of the half before: a word met in both stays
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = _lately.get(path, {})
        self.path = path

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts, each followed by the end id, and where
        each text ends in them. ``texts`` has no nulls."""
        # A copy of its own: Arrow's letter functions misplace the values of a slice.
        texts = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))
        split = pc.ascii_split_whitespace(_fewer_forms(texts))
        flat = pc.list_flatten(split).dictionary_encode()
        coded = self._words(flat.dictionary.to_numpy(zero_copy_only=False).tolist())
        _lately[self.path] = self.known
        coded.append(END_ID.to_bytes(4, "little"))  # the end id is one more word of every text
        offsets = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) // 4)
        pool = pa.array(np.frombuffer(b"".join(coded), np.uint32))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, offsets).astype(np.int32)), pool)
        word_ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        index = np.insert(flat.indices.to_numpy(zero_copy_only=False), word_ends, len(coded) - 1)
        taken = lists.take(pa.array(index))
        ends = taken.offsets.to_numpy()[word_ends + np.arange(1, len(word_ends) + 1)] - taken.offsets[0].as_py()
        return taken.flatten().to_numpy(), ends.astype(np.int64)

    def _words(self, words: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word."""
        coded = list(map(self.known.get, words))
        missing = [i for i, c in enumerate(coded) if c is None]
        if missing:
            found = list(map(self.before.get, [words[i] for i in missing]))
            unknown = [words[i] for i, c in zip(missing, found) if c is None]
            new = self._encode(unknown) if unknown else {}
            for i, c in zip(missing, found):
                word = words[i]
                coded[i] = c = new[word] if c is None else c
                if len(word) <= CACHED_BYTES:
                    self._remember(word, c)
        return coded

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        coded, rest, merge = {}, [], self.tokenizer.model.tokenize
        for word in words:
            if _plain(word):  # nothing to normalise or split: only the merges are left to do
                letters = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
                coded[word] = array("I", [t.id for t in merge(letters)]).tobytes()
            else:
                rest.append(word)
        for begin in range(0, len(rest), 4096):
            some = rest[begin : begin + 4096]
            for word, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                coded[word] = array("I", e.ids).tobytes()
        return coded

    def _remember(self, word: str, ids: bytes) -> None:
        if len(self.known) >= CACHED_WORDS // 2:
            self.known, self.before = {}, self.known
        self.known[word] = ids
