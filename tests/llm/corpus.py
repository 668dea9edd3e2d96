"""Small documents with every odd case, and helpers."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
WORDS = {
    "en": "the of and to in that is was for it with as his on be at by had not are but from or have".split(),
    "de": "der die und das nicht ist ein zu den mit sich auf für dem im eine als auch werden über".split(),
    "fr": "le de la et les des en un du une que est pour qui dans être avec son mais où déjà".split(),
}


def sentence(lang: str, words: int, seed: int) -> str:
    draw = random.Random(f"{lang}/{seed}")
    return " ".join(draw.choice(WORDS[lang]) + draw.choice(["", "", "s", "en", "er", "ion", "ly"]) for _ in range(words))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def plain(n: int = 60, words: int = 60) -> list[tuple]:
    return [row(k, sentence(("en", "de", "fr")[k % 3], words, k), ("en", "de", "fr")[k % 3], f"s{k % 4}") for k in range(n)]


def odd() -> list[tuple]:
    """Nulls, empty and wordless texts, repeated rows, shared ids, a very long text."""
    long_text = sentence("en", 30_000, 7)
    return [
        row(1000, None, None, None),
        row(None, sentence("en", 40, 1), "en", "a"),
        row(1001, "", "en", "a"),
        row(1002, " \n\t ", "en", None),
        row(1003, "12 34 %%%", "de", "b"),
        row(1004, "same text here twice again and again", "en", "b"),
        row(1004, "same text here twice again and again", "en", "b"),
        row(1005, "same text here twice again and again", "en", "b"),
        row(1005, "another text under an id that is taken", "en", "b"),
        row(1006, long_text, "en", "long"),
        row(1007, "Zürich 日本語 🙂 naïve", "de", "é"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS)
