"""Example frames for the operators of training data."""

from __future__ import annotations

import pytest
from llm.examples import CLASHES, DOCS, awkward


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHES)))
