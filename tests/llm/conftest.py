import os

import pytest

#: Texts that every operator must take: nulls, empty and blank texts, a very long one, ties, repeated rows.
ODD_TEXTS = [None, "", " \n\t ", "word", "###\x1c!!", "é" * 50, "long words here " * 20_000]


@pytest.fixture()
def odd_docs(spark):
    """Odd texts, a null id, repeated rows, and extra columns whose names clash with results."""
    rows = [(i, t, None if i % 2 else "en", "s", 0, 9, "clash") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "an id of null here", "en", None, 1, 9, "clash"), (3, "word", None, "s", 0, 9, "clash"), (3, "word", None, "s", 0, 9, "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, score string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (4, 0, 1), (None, 1, 1), (5, None, None), (77, 1, 1)], "doc_id long, quality int, toxic int")


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    assert os.path.isdir(SF)
    return SF
