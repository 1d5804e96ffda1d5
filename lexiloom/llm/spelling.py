"""Spelling variants: words one edit apart, by an index of variable-length grams.

1. Words and their counts come from the documents by Spark functions alone.
2. Gram dictionary. A word is padded on both sides; the grams of ``SHORTEST`` to
   ``LONGEST`` signs that occur more than ``RARE`` times over all words are the
   *frequent* ones. The dictionary is pruned by frequency: should there be more than
   ``DICTIONARY`` of them, the bound on the count rises. That costs candidates, never
   results, and keeps what is sent to the tasks small.
3. Decomposition. At every place of a word the gram is lengthened while it is
   frequent; grams inside an earlier one are left out (``decompose``). A gram depends
   on its own signs only, so an edit leaves all others in place.
4. Affected grams. For every place of a word at which a longer or equally long word
   may differ, ``untouched`` gives the grams that the edit cannot change: not those that
   hold the place, nor those behind it that a longer gram might swallow. A near word
   that differs there holds all of them, at the same place or one further.
5. List merging. Two of these lists are merged for each place of edit: the rarest gram
   before and the rarest behind it; one list alone where a gram is rare. The index
   holds a word under its rare grams and under pairs of frequent ones (with the places
   and the length of the word), so merging is a join on a 64-bit key. Where fewer than
   two grams are untouched (short words only) the one list is read, which holds words of
   one length; where none is, the list of all words of that length that are as short.
6. Candidates are verified: an edit distance of one. Form and root follow from the
   near words; roots by doubling the steps, which are few because each form has at least
   twice the count.

Long words. Only the first and last ``ENDS`` grams of a word are indexed, so a word has
a bounded number of keys; an edit at one end leaves the other as it was.

Defined results: a null text has no words; very long texts and runs need no more than
a task; ties of count go to the word that is smaller in code-point order; repeated rows
count again. A null id takes part as an empty one. Extra columns are ignored, whatever
their names; an empty table gives no rows. Words without near words have null for form
and form_n, zero for n_near and themselves for root.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.store import map_arrow, stored
from lexiloom.operators.skew import spread_join

RUN = "[A-Za-zÀ-ÿ]+"
SHORTEST, LONGEST = 2, 6
RARE = 100
DICTIONARY = 200_000
ENDS = 12
COUNTED = 400_000  # different grams a task counts before it passes them on
BEGIN, END = "\x02", "\x03"  # padding, which no run holds
_PAD = LONGEST - 1


# words


def _lower(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def _with_noise(doc: Column, run: Column, every: int) -> Column:
    """The run, or for one in ``every`` hashes of (document, run) the run without one sign."""
    h = F.crc32(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = 5,
    least: int = 3,
    every: int = 97,
) -> DataFrame:
    """(word, n) of the runs of letters, lower-cased from A to Z and with one sign
    deleted in some; words of ``shortest`` signs and ``least`` occurrences on."""
    runs = docs.select(
        F.col(id_col).alias("doc"), F.explode(F.regexp_extract_all(_lower(F.col(text_col).cast("string")), F.lit(RUN), F.lit(0))).alias("run")
    ).where(F.length("run") >= shortest)
    # A word of a run too short here would be shorter still.
    words = runs.select(_with_noise(F.col("doc"), F.col("run"), every).alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


# grams


def padded(word: str) -> str:
    return BEGIN * _PAD + word + END * _PAD


def decompose(s: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """(start, end) of the grams of a padded word, in order; starts and ends both ascend."""
    out, covered, n = [], 0, len(s)
    for p in range(n - SHORTEST + 1):
        j = p + SHORTEST
        while j < n and j - p < LONGEST and s[p:j] in frequent:
            j += 1
        if j > covered:
            out.append((p, j))
            covered = j
    return out


def untouched(s: str, grams: dict[int, tuple[int, int]], frequent: dict[str, int], at: int, inserted: bool) -> tuple[list[int], list[int]]:
    """Numbers of the grams before and behind place ``at`` that stay as they are when
    the sign there is replaced or deleted, or another is inserted before it."""
    before = [k for k, (_, j) in grams.items() if j <= at]
    # A gram that holds the edit may grow to this place, over grams behind it; all but its
    # last sign are then frequent.
    first, reach = (at, at + LONGEST - 1) if inserted else (at + 1, at + LONGEST)
    behind = [
        k
        for k, (p, j) in grams.items()
        if p >= first and (j > reach or (j - 1 - first >= SHORTEST and s[first : j - 1] not in frequent))
    ]
    return before, behind


def _list_key(gram: str, at: int, length: int) -> int:
    return zlib.crc32(f"{at} {length} {gram}".encode())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Keys:
    """Keys under which a word is indexed, and keys of the lists that it merges."""

    def __init__(self, word: str, frequent: dict[str, int]):
        self.s, self.frequent = padded(word), frequent
        grams = decompose(self.s, frequent)
        self.n = len(grams)
        # The grams of both ends by their number; for all but long words these are all grams.
        self.grams = {k: g for k, g in enumerate(grams) if k < ENDS or k >= self.n - ENDS}
        self.size = {k: frequent.get(self.s[p:j], 0) for k, (p, j) in self.grams.items()}  # 0: rare

    def _gram(self, k: int, shift: int, length: int) -> int:
        p, j = self.grams[k]
        return _list_key(self.s[p:j], p + shift, length)

    @staticmethod
    def _all(length: int) -> int:
        return _list_key("", 0, length)

    def index(self) -> tuple[list[int], list[int]]:
        """(keys of rare grams and of pairs of frequent ones, keys of single frequent grams)."""
        length = len(self.s)
        own = {k: self._gram(k, 0, length) for k in self.grams}
        often = [own[k] for k, size in self.size.items() if size]
        keys = {own[k] for k, size in self.size.items() if not size}
        keys |= {_signed(a << 32 | b) for a, b in combinations(often, 2)}
        return list(keys), list({*often, self._all(length)})

    def probes(self) -> tuple[list[int], list[int]]:
        """Keys to look up in either part of the index, for words as long or one longer."""
        merged, single = set(), set()
        for inserted in (False, True):
            length = len(self.s) + inserted
            for at in self._places(inserted):
                before, behind = untouched(self.s, self.grams, self.frequent, at, inserted)
                # Numbers from the front hold before the edit, numbers from the back behind it.
                lists = [(self.size[k], k, 0) for k in before if k < ENDS]
                lists += [(self.size[k], k, int(inserted)) for k in behind if k >= self.n - ENDS]
                if not lists:
                    single.add(self._all(length))
                    continue
                rarest = min(lists)
                key = self._gram(rarest[1], rarest[2], length)
                if not rarest[0]:
                    merged.add(key)
                elif len(lists) == 1:
                    single.add(key)
                else:
                    other = min(x for x in self._apart(lists, rarest[1]) if x[1] != rarest[1])
                    low, high = sorted([(rarest[1], key), (other[1], self._gram(other[1], other[2], length))])
                    merged.add(_signed(low[1] << 32 | high[1]))
        return list(merged), list(single)

    def _places(self, inserted: bool) -> list[int]:
        """Places of edit. Between the ends of a long word, all grams of the ends are
        untouched wherever the edit is, so one place stands for all."""
        places = range(_PAD, len(self.s) - _PAD + inserted)
        if self.n <= 2 * ENDS:
            return list(places)
        low, high = self.grams[ENDS - 1][1], self.grams[self.n - ENDS][0] - LONGEST - 1
        return [at for at in places if at <= low or at >= high]

    def _apart(self, lists: list[tuple[int, int, int]], k: int) -> list[tuple[int, int, int]]:
        """The lists of grams that share no sign with gram ``k``, if there are any: they say more."""
        p, j = self.grams[k]
        apart = [x for x in lists if self.grams[x[1]][0] >= j or self.grams[x[1]][1] <= p]
        return apart or lists


def frequent_grams(words: DataFrame, rare: int = RARE, most: int = DICTIONARY) -> dict[str, int]:
    """The frequent grams and their counts over all words, ``most`` at most.

    A gram that is frequent has frequent parts; ties at the bound are cut together,
    so that this stays true.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])

        for batch in batches:
            for word in batch.column("word").to_pylist():
                s = padded(word)
                for size in range(SHORTEST, LONGEST + 1):
                    counts.update(s[p : p + size] for p in range(len(s) - size + 1))
                if len(counts) > COUNTED:
                    yield rows()
                    counts.clear()
        yield rows()

    counted = map_arrow(words.select("word"), count, "gram string, n long")
    grams = counted.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > rare)
    top = grams.orderBy(F.desc("n")).limit(most + 1).collect()
    if len(top) > most:
        top = [r for r in top if r["n"] > top[-1]["n"]]
    return {r["gram"]: r["n"] for r in top}


def near_pairs(words: DataFrame, rare: int = RARE, most: int = DICTIONARY) -> DataFrame:
    """(word, n, other, other_n), one row per pair of words at an edit distance of one.

    ``words`` (word, n) holds different words and is read several times.
    """
    spark = words.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_grams(words, rare, most))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for batch in batches:
            lists: list[list] = [[], [], [], []]
            for word in batch.column("word").to_pylist():
                own = Keys(word, known)
                for column, found in zip(lists, (*own.index(), *own.probes())):
                    column.append(found)
            arrays = [pa.array(c, pa.list_(pa.int64())) for c in lists]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *arrays], names)

    names = ["word", "n", "held", "held_single", "wanted", "wanted_single"]
    arrays = ", ".join(f"{c} array<bigint>" for c in names[2:])
    keyed = stored(map_arrow(words.select("word", "n"), keys, f"word string, n long, {arrays}"))

    def side(name: str, column: str) -> DataFrame:
        return keyed.select(F.explode(column).alias("key"), F.col("word").alias(f"{name}word"), F.col("n").alias(f"{name}n"))

    # Few words want single lists, and few lists: only those are sent.
    single = stored(side("a", "wanted_single"))
    lists = single.select("key").distinct()
    met = side("b", "held").join(side("a", "wanted"), "key").unionByName(
        spread_join(side("b", "held_single").join(lists, "key", "left_semi"), single, ["key"], "inner", ["bword"])
    )
    verified = met.where((F.col("aword") != F.col("bword")) & (F.levenshtein("aword", "bword", 1) == 1))
    first = F.col("aword") < F.col("bword")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return verified.select(
        pick("aword", "bword").alias("word"), pick("an", "bn").alias("n"),
        pick("bword", "aword").alias("other"), pick("bn", "an").alias("other_n"),
    ).distinct()


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE, most: int = DICTIONARY, **how) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest count, if that is at least twice the word's;
    ``root`` follows the forms to the last.
    """
    words = stored(word_counts(docs, id_col, text_col, **how))
    pairs = near_pairs(words, rare, most)
    both = pairs.select("word", "other", F.col("other_n")).unionByName(
        pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("other_n"), "other")).alias("best"))
    near = best.select("word", "n_near", F.col("best.other").alias("form"), (-F.col("best.col1")).alias("form_n"))
    enough = F.col("form_n") >= 2 * F.col("n")
    found = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
        )
    )
    roots = _roots(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(steps: DataFrame) -> DataFrame:
    """The last word reached from each word of ``steps`` (word, root), whose forms have
    twice the count each: a chain is as long as the logarithm of the largest count."""
    steps, moved = stored(steps), True
    while moved:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # Many words may share a form, so the rows of one are dealt.
        stepped = stored(spread_join(steps, further, ["root"], "left", ["word"]))
        moved = not stepped.where("next IS NOT NULL").isEmpty()
        steps = stepped.select("word", F.coalesce("next", "root").alias("root"))
    return steps
