"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing column names."""
import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ("row", "id", "sha", "keep_id", "keep_sha", "n", "node", "sig", "gone", "words", "copies", "copy", "from", "d",
           "s", "z", "h", "norm", "prefix", "part", "key", "y", "score", "kept", "size", "taken", "__o0", "__b", "label")


def messy_rows():
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta,", "eta.", "idiot", "x"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    same = " ".join(rng.choice(words) for _ in range(40))
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\r\n\x0b\x0c ", "en", "a", 7), (4, "one", "de", "b", 3),
        (5, same, "en", "a", 1), (6, same, "en", "a", 1), (7, same.replace(" ", "  "), "fr", None, 1), (8, long, "en", "a", 1),
        (9, long, None, "c", None), (10, "12 345 !!", "en", "b", 9), (11, "日本語 テキスト", "ja", "c", 8),
        (12, "a b  c \x1c d", "en", "", 5), (12, "a b  c \x1c d", "en", "", 5), (None, same, "en", "a", 1),
        (None, None, None, None, None), (13, "<|endoftext|> <s> ▁x  ▁", "en", "b", 4), (14, "one", "de", "b", 3),
        (12, "other text", "en", "", 5),
    ]


def messy(spark):
    df = spark.createDataFrame(messy_rows(), SCHEMA)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
