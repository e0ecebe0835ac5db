"""Small documents with the cases every operator has to define."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = ["th", "an", "er", "ou", "ing", "ed", "re", "st", "ño", "é"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(n))


def documents(spark, rows):
    """A documents frame from (doc_id, text, source) rows."""
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows, copies, near copies."""
    base = prose(1, 400)
    words = base.split()
    near = " ".join(words[:200] + ["changed"] + words[201:])
    passage = prose(2, 120)
    rows = [
        (1, base, "a"), (2, base, "a"), (3, near, "b"), (4, None, None), (5, "", "a"), (6, " \t\n ", "b"),
        (7, "one two", "c"), (8, "one two", None), (9, prose(3, 60) + "\n" + passage + "\n" + prose(4, 50), "a"),
        (10, prose(5, 30) + " " + passage + " " + prose(6, 90), "b"), (11, prose(7, 20000), "a"),
        (12, "x " * 3000, "d"), (12, "x " * 3000, "d"), (None, prose(8, 50), "e"), (13, base, "a"),
        (14, "solo", "f"), (15, "A" * 1200 + prose(9, 10), "a"),
    ]
    return rows + [(100 + i, prose(100 + i, 20 + 13 * i), "abc"[i % 3]) for i in range(40)]


def save(spark, folder, rows, labels=None, pages=None):
    """The tables a query reads, below ``folder``."""
    documents(spark, rows).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels or [], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame(pages or [], "page_id long, url string, html string").write.mode("overwrite").parquet(
        f"{folder}/pages.parquet")
    return str(folder)
