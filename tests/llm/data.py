"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

PASSAGE = "the quick brown fox jumps over the lazy dog and " * 3 + "then it sleeps in the warm sun until the evening comes to the quiet hill above."


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def awkward(seed: int = 3) -> list[tuple]:
    """(doc_id, text, source) with nulls, empty and long texts, copies, ties and repeated rows."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(60, 200)) for _ in range(12)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100 + i, base[0], "s0") for i in range(5)]  # copies
    near = base[1].split()
    near[7] = "changed"
    rows += [(200, " ".join(near), "s1"), (201, base[2] + " tail", None)]
    rows += [(300 + i, words(rng, 30) + "\n" + PASSAGE + "\n" + words(rng, 30), "s2") for i in range(6)]
    rows += [(400, None, "s0"), (401, "", None), (402, " \n\t ", "s1"), (403, "one", "s1"), (404, None, None)]
    rows += [(500, "a" * 3000, "s2"), (501, words(rng, 4000), "s2"), (502, "ünïcödé " * 60 + "日本語" * 100, "s2")]
    rows += [(rows[3][0], rows[3][1], rows[3][2])] * 2  # repeated rows
    rows += [(None, base[4], "s1"), (None, "of null ids", "s1")]
    return rows


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The rows with extra columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.selectExpr("*", "'x' AS d", "1 AS key", "2.5D AS n", "'y' AS id", "'z' AS row", "3 AS kept", "4 AS h", "'w' AS rank")


def empty(spark: SparkSession) -> DataFrame:
    return frame(spark, []).limit(0)
