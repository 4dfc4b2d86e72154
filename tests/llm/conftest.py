from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    long = " ".join(words[(i * i + 3 * i) % 20] + str(i % 97) for i in range(30_000))
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (3, long, "en", "a", 1), (4, long + " end", "en", "a", 1),
            (5, " ".join(words), "fr", "b", 1), (6, " ".join(words), "fr", "b", 1), (6, " ".join(words), "fr", "b", 1),
            (None, "x y z", "en", "b", None), (None, None, None, None, None), (7, "▁ odd \x00﻿\n\né日", "xx", "c", 2),
            (8, "...", "en", "c", 3), (7, "another text of the same id", "en", "c", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    extra = ("_id _h _text n keep digest rate units label node score spans ids kept count value _file _row _copy part mask id "
             "word form root").split()
    return df.withColumns({name: F.lit("clash") for name in extra})


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.filter("false")
