import pytest

from govlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, shuffle_partitions=8, app="govlake-tests")


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf_small):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]


#: Nulls, empty and very long texts, ties, repeated rows, one repeated unit.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "word " * 30000), (5, "word " * 30000), (None, "word " * 60),
    (7, " ".join(f"w{i % 97}" for i in range(5000))), (8, " ".join(f"w{i % 97}" for i in range(40, 400))),
    (9, "é" * 300), (10, "é" * 150), (11, "x" + "é" * 120 + "y"), (12, None), (12, "Ünïcode text \U0001F600 end"),
]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
