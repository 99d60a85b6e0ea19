"""Rows for the tests of the corpus operators."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CHECKED = "/root/testdata/sf0.01"
WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu", "ra", "so", "ti") for b in ("n", "r", "st", "va", "lo", "mi")]


def prose(seed: int, words: int, line: int = 12) -> str:
    draw = random.Random(seed)
    found = [draw.choice(WORDS) + draw.choice(WORDS) for _ in range(words)]
    return "\n".join(" ".join(found[i : i + line]) + "." for i in range(0, words, line))


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]), with columns whose names operators use themselves."""
    full = [(*row, *("en", "src0")[len(row) - 2 :], None if row[1] is None else len(row[1])) for row in rows]
    names = ("row", "key", "node", "count", "shard", "kept", "findings", "licences", "n_dropped", "n_words", "row_number")
    return spark.createDataFrame(full, SCHEMA).withColumns({name: F.lit("theirs") for name in names})


ODD = [
    (1, None),
    (2, ""),
    (None, "a text without a number"),
    (3, " \t\n\x0b "),
    (4, "word"),
    (4, "word"),
    (5, "x" * 5000),
    (6, prose(6, 4000)),
    (7, "l'été, 漢字 😀\r\nend"),
]
