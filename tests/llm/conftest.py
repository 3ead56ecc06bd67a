import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    long = "lorem ipsum dolor password=hunter2abc sit amet idiot " * 4000
    rows = [(1, "plain words here", "a"), (1, "plain words here", "a"), (None, None, None), (2, "", "b"), (3, None, "b"),
            (None, "token: abc123def", "c"), (4, long, "d"), (5, "plain words here", "e"), (6, "naïve 漢字 🙂 it's  two   spaces ", "f")]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string")
            .withColumns({"id": F.lit("x"), "ids": F.lit("y"), "n": F.lit(1), "score": F.lit(0.5), "hash": F.lit(2), "size": F.lit(3)}))


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.where("false")
