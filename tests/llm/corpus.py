"""Small corpora for the text operators, with every awkward case the docstrings name."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, kept string, row_hash int, tid int"
WORDS = "the of and rain river stone cloud garden window market yellow green letter music winter summer paper table".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (f"{rng.randrange(40)}" if rng.random() < 0.5 else "") for _ in range(n))


def texts() -> list[str | None]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    long = prose(2, 20_000)
    lines = "\n".join(prose(k, 12) for k in range(3))
    shared = prose(77, 40)
    return [
        None, "", "   \n\t ", "one", "one two three four", base, base, " ".join(near), long, long + " end",
        "be " * 300, lines + "\n" + lines, "a|b|c # $ %" * 20, "É" * 150 + " ß İ", prose(5, 60) + " " + shared,
        prose(6, 70) + "\n" + shared + "\n" + prose(7, 50), "x" * 500, "the rain and the river " * 15,
        *[prose(100 + k, 80) for k in range(12)],
    ]


def docs(spark: SparkSession, given: list[str | None] | None = None) -> DataFrame:
    """One row per text, in four sources and two languages, with clashing extra
    columns; then a row without an id and an exact repetition of a row."""
    given = texts() if given is None else given
    rows = [
        (k, t, None if k % 7 == 3 else ("en", "de")[k % 2], None if k % 5 == 4 else f"s{k % 4}", 1, "x", "y", 3, 4)
        for k, t in enumerate(given)
    ]
    if rows:
        rows += [(None, given[-1], "en", "s1", None, None, None, None, None), rows[-2]]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
