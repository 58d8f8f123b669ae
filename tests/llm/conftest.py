from __future__ import annotations

import pytest
from pyspark.sql import functions as F

#: Rows with nulls, empty and very long texts, repeated rows, special strings and odd characters.
ODD = [
    (None, None, None), (None, "A text without an id, of a few words only.", "en"), (9001, None, "en"), (9002, "", "fr"), (9003, " \t\n ", None),
    (9004, "The same row twice, word for word, is here.", "en"), (9004, "The same row twice, word for word, is here.", "en"),
    (9005, "one", "de"), (9006, "1234 5678 !!! ???", "en"), (9007, "x" * 30_000, None), (9008, ("word " * 40_000).strip(), "en"),
    (9009, "don't <|endoftext|> stop   now\n\n\nend  <|startoftext|> é 😀   ﬁ", "es"), (9010, "\u00a0\u2003 \u200b", "en"), (9011, "aaaa" * 300 + " b", "en"),
    (9012, "École ​ zero width line", "fr"), (9013, "a\nb\na\n\na", "en"),
]


@pytest.fixture(scope="session")
def docs(spark, sf):
    """The driver's documents, odd rows, and further columns whose names clash with those of the operators."""
    own = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    out = own.unionByName(odd)
    clash = "id fp label key n p value part gram score predicted kept n_words lower ids path count node size __text n_tokens toxic __row __row2 __found row row2 pick check sketch mask language statistics chars features raw license dice held".split()
    for k, name in enumerate(clash):
        out = out.withColumn(name, F.lit(f"clash {k}"))
    return out.withColumn("source", F.lit("src")).withColumn("n_chars", F.length("text").cast("long")).cache()


@pytest.fixture(scope="session")
def texts(docs):
    """``(doc_id, text)`` of all rows."""
    return [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def none(docs):
    """The same table without rows."""
    return docs.limit(0)
