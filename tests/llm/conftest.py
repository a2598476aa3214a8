import pytest

from ridemart.session import ship_package

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


#: Odd documents: null and empty texts, repeated rows and texts, a null id, white space, a long text.
ODD = [(1, "The cat sat on the mat", "x", 0.5), (1, "The cat sat on the mat", "x", 0.5), (2, None, "x", None),
       (3, "", None, 0.1), (4, " \n\t ", "y", 0.2), (None, "the CAT sat on the mat", "y", 0.3),
       (5, "Élan é ñandú 日本語 <|endoftext|> don't", "z", 0.4), (6, "word " * 30_000, "z", 0.5),
       (7, "The cat sat on the mat", "z", 0.5)]


@pytest.fixture(scope="session")
def odd(spark):
    """Extra columns have names that the operators use themselves."""
    return spark.createDataFrame(ODD, "doc_id long, text string, row string, score double")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, row string, score double")
