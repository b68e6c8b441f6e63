import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Columns whose names the operators use themselves.
    T.StructField("size", T.StringType()), T.StructField("score", T.StringType()), T.StructField("n_lines", T.LongType()),
    T.StructField("copies", T.StringType()), T.StructField("row", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("_line_id", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("p", T.StringType())])


def doc(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * 2, 7, *["x"] * 6)


def odd_rows():
    rng = random.Random(4)
    long_text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta\n", "  ", "été"]) for _ in range(60_000))
    rows = [doc(1, None), doc(2, ""), doc(3, " \t\n \x0b"), doc(4, "One word"), doc(5, "x"), doc(6, long_text),
            doc(7, long_text + " end"), doc(8, "a\u0000b   c d"), doc(9, "123 456 !!"), doc(None, "no id at all"),
            doc(None, None), doc(10, "no source", source=None), doc(11, "no lang", lang=None), doc(12, "  X \n x\nX"),
            doc(13, "same same same same same same same same")]
    return rows + [doc(14, "repeated row\nwith two lines")] * 3 + [doc(14, "same id, another text")]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
