"""Frames for the tests of the corpus operators; test modules import the fixture."""

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Frame of documents from (doc_id, text) pairs, with columns whose names clash with results."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, fp string, doc string"

    def build(*rows, partitions=3):
        data = [(r[0], r[1], *(r[2:] + ("en", "s")[len(r) - 2:] if len(r) < 4 else r[2:]), len(r[1] or ""), "x", "x", "x", "x") for r in rows]
        return spark.createDataFrame(data, schema).repartition(partitions)

    return build
