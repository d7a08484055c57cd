import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text, source) rows as a documents table."""

    def make(rows):
        full = [(i, t, None if k % 3 == 0 else "en", s, None if t is None else len(t)) for k, (i, t, s) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, ties, repeated rows."""
    long = " ".join(f"word{k % 977} the and" for k in range(60_000))
    same = "the same text again and again in the corpus of this"
    return [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n ", None),
        (4, long, "b"),
        (5, same, "b"),
        (6, same, None),
        (7, same.upper(), "a"),
        (8, same, "b"),
        (8, same, "b"),
        (9, "one", "a"),
        (10, "two words", "c"),
        (11, "é ñ \U0001f600 漢字 ß", "c"),
        (12, long + " tail", "c"),
        (None, "a row without an id in the table", "a"),
        (None, same, "b"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, make_docs, odd_rows):
    """The odd rows with extra columns whose names the operators also use."""
    from pyspark.sql import functions as F

    names = "size rank kept score bucket batch length key n label rep class _maybe _slot _word _bits _nth _sha _size _doc _place".split()
    return make_docs(odd_rows).select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)]).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
