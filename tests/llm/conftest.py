import pytest

from llm_plain import DOCS_DDL, SF, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows(), DOCS_DDL).repartition(3, "n_chars")
    return docs.withColumns({c: F.lit(f"x-{c}") for c in (
        "size", "kept", "row", "h", "arc", "shard", "first", "label", "th", "sid", "token", "idx", "block", "picked", "w")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS_DDL)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
