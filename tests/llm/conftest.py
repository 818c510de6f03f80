import pytest

import llm_brute

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, long texts, repeats and columns whose names clash with inner ones."""
    return spark.createDataFrame(llm_brute.odd_rows(), llm_brute.SCHEMA)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_texts():
    return [(r[0], r[1]) for r in llm_brute.odd_rows()]


@pytest.fixture(scope="session")
def text_queries():
    from spendwatch.llm.catalog import load_catalog

    return load_catalog()[0]
