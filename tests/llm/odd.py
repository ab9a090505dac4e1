"""Rows every operator has to take: NULLs, empty and long texts, repeated rows and ids, columns with clashing names."""

from __future__ import annotations

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, part string, cls bigint, target double, "
    "`row` string, begin int, fp string, _cls string, chunk int, label string, html string, y int, _id bigint, id bigint, key string, a int, b int"
)
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 4000


def rows() -> list[tuple]:
    texts = [
        (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a"),
        (2, "one two three four five six seven eight nine ten eleven twelve", "en", "b"),
        (3, None, "en", "a"),
        (4, "", None, None),
        (5, " \t\n ", "de", None),
        (6, "word", "en", "a"),
        (7, LONG, "en", "a"),
        (8, "naïve café 東京 \U0001f600 ok", None, "ü"),
        (8, "naïve café 東京 \U0001f600 ok", None, "ü"),
        (8, "same id, other text", "en", "ü"),
        (None, "no id at all here", "en", "a"),
        (None, "no id at all here", "en", "a"),
        (9, "x" * 50_000, "en", "a"),
        (9007199254740993, "an id beyond the doubles", "en", "b"),
        (10, "one two three four five six seven eight nine ten eleven twelve thirteen", "en", None),
    ]
    return [(i, t, l, s, len(t) if t else None, 1, "p", 2, 0.5, "r", 3, "f", "c", 4, "l", t, 5, 6, 7, "k", 8, 9) for i, t, l, s in texts]


def docs(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)


def empty(spark):
    return docs(spark, [])
