import random

import pytest

from arbolytics.llm import common, neighbours


@pytest.fixture(autouse=True)
def few_pieces(spark, monkeypatch):
    """Small tables take few tasks here."""
    monkeypatch.setattr(common, "LEAST_PIECES", 5)
    monkeypatch.setattr(neighbours, "LEAST_BLOCKS", 3)
    common.ship(spark)


@pytest.fixture
def docs(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def words():
    def make(n, seed, of=400):
        pick = random.Random(seed)
        return [f"w{pick.randrange(of)}" for _ in range(n)]

    return make
