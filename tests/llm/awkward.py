"""Documents that operators stumble over: nulls, empty and long texts, repeated rows, columns with clashing names."""

from __future__ import annotations

import re

# Names that operators use inside; a table may have them too.
CLASHING = ["key", "body", "bare", "rep", "bucket", "h", "seed", "score", "label", "sample_id", "n", "gone_id", "chars", "spans"]
LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(30_000))
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

TEXTS = [
    (1, "one two three four five six seven eight"),
    (2, "one two three four five six seven eight"),
    (3, "One  TWO three\tfour five\nsix seven eight"),
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r"),
    (7, "two words"),
    (8, "TWO words"),
    (9, LONG),
    (10, LONG + " end"),
    (11, "x" * 200_000),
    (12, "é日本語😀 ▁   \x85 tail"),
    (None, "without an id"),
    (None, None),
    (13, "repeated row"),
    (13, "repeated row"),
]


def documents(spark, rows=TEXTS):
    extra = [f"{c} string" for c in CLASHING]
    schema = ", ".join(["doc_id bigint", "text string", *extra])
    return spark.createDataFrame([(d, t, *["?"] * len(CLASHING)) for d, t in rows], schema)


def nothing(spark):
    return documents(spark, [])


def split_words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
