"""Small documents with every awkward case, and helpers of the tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997} tail{i}" for i in range(60_000))


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
                    for _ in range(words))


def messy(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    long_line = sentence(rng, 60)
    same = sentence(rng, 30) + "\n" + long_line
    rows = [
        (1, same, "en", "a", 1), (2, same, "en", "a", 1), (2, same, "en", "a", 1),
        (3, None, "en", None, None), (4, "", None, "b", 0), (5, " \n\t ", "de", "b", 4),
        (None, sentence(rng, 25), "de", "b", 3), (None, None, None, None, None),
        (6, LONG, "en", "a", len(LONG)), (7, "é", None, "a", 1),
        (8, same.replace(same.split()[3], "changed", 1), "en", "a", 2),
        (9, "x" * 5000, "en", "a", 5000), (-4, "  \x85 tail\x1c\n\n", "fr", "c", 9),
        (10, sentence(rng, 12) + "\n" + long_line + "\n" + long_line, "en", "c", 0),
    ]
    rows += [(100 + i, sentence(rng, rng.randint(1, 40)), rng.choice(["en", "de", None]), "d", 0)
             for i in range(20)]
    return rows


def docs(spark: SparkSession, rows: list[tuple], fields: str = FIELDS) -> DataFrame:
    return spark.createDataFrame(rows, fields)


def by_id(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
