"""Small tables with every awkward row: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, key string, fp long, label string, row int, "
          "score double, evidence string, shard int, row_hash long")


def documents(spark, texts: list[tuple[int | None, str | None]], clash: bool = True):
    rows = [(i, t, "en", "s", len(t or ""), 1, "k", 2, "l", 3, 0.5, "e", 4, 5) for i, t in texts]
    df = spark.createDataFrame(rows, SCHEMA)
    return df if clash else df.select("doc_id", "text", "lang", "source", "n_chars")


AWKWARD = [
    (None, None), (None, ""), (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (6, "one two three four"),
    (7, "One TWO three four"), (7, "One TWO three four"), (8, "ünï cödé ßtring Ünï 日本 語 😀 é"), (9, "x" * 50_000),
    (10, "word " * 30_000), (11, "a\x1cb c\x85d e"), (None, "one two three four"), (12, "tok ▁ en"),
]


def rows_of(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]
