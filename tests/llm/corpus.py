"""Small corpora for the tests of the corpus operators."""

import os

SMALL = "/root/testdata/sf0.001"

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, shard string, score string, row string,"
        " value string, key string, turn int, node int")


def prose(seed: int, words: int) -> str:
    import random

    rng = random.Random(seed)
    syllables = "ba do ki lu me no pa ri so tu ve wa xo yi zu".split()
    out = []
    for i in range(words):
        w = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
        out.append(w + ("." if rng.random() < 0.1 else ""))
    return " ".join(out)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long = prose(1, 40_000)
    extra = (None, "x", None, "row", "v", "k", 1, 2)
    rows = [
        (1, None, "en", "s1"), (2, "", "en", "s1"), (3, " \n\t ", None, None), (None, "no id here at all, only five words", "en", "s2"),
        (None, None, None, None), (4, long, "en", "s1"), (5, prose(2, 300), "en", "s2"), (5, prose(2, 300), "en", "s2"),
        (6, prose(2, 300), "fr", None), (6, "one", "en", "s2"), (7, "ONE", "en", "s1"), (8, "…é ñ 😀 ok", "es", "s3"),
        (9, "word " * 200, "en", "s3"), (-1, "line\nline\nline\n", "en", ""),
    ]
    return [(*r[:4], len(r[1]) if r[1] else None, *extra[1:]) for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOCS)


def docs(spark, texts: dict):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def read(spark, name: str, sf: str = SMALL):
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))
