"""Small documents with every hard case, and plain re-statements of the definitions."""

import re

from pyspark.sql import types as T

WORDS = re.compile(r"[^\x20\x09-\x0d]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: documents with extra columns whose names operators use themselves
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("n_tokens", T.StringType()), T.StructField("ids", T.StringType()),
    T.StructField("digest", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("decoded", T.StringType()), T.StructField("epoch", T.StringType()),
    T.StructField("word", T.StringType())])


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), *["clash"] * 8)


def prose(seed, n):
    import random
    rng = random.Random(seed)
    return " ".join(rng.choice(["ra", "to", "mi", "ne", "sol"]) + str(rng.randrange(400)) for _ in range(n))


HARD = [
    row(1, None), row(2, ""), row(3, "  \t\n "), row(4, "one"), row(5, prose(1, 60)), row(6, prose(1, 60)),
    row(7, prose(2, 80)), row(8, prose(2, 79) + " end"), row(9, prose(3, 20_000), None), row(10, "Ünï çødé 日本 🙂 " * 3),
    row(None, prose(4, 30)), row(None, None), row(11, prose(5, 12), None), row(11, prose(5, 12), None),
    row(12, prose(6, 12)), row(12, prose(7, 12)), row(13, "x" * 30_000), row(14, "same same same same same same")]


def hard(spark):
    return spark.createDataFrame(HARD, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


def same_rows(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))
