import pytest
from edge_cases import FOLDER, SCHEMA, TEXTS


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeats, and columns named like those of the operators."""
    rows = [(i, t, *["x"] * (len(SCHEMA) - 2)) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(corpus):
    return {r["doc_id"]: r["text"] for r in corpus.select("doc_id", "text").collect()}
