import itertools

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block string, n long"


@pytest.fixture()
def docs(spark):
    """Documents with nulls, empty and long texts, ties, repeats and odd columns."""

    def build(texts, ids=None, sources=None):
        ids = ids or itertools.count()
        sources = sources or itertools.repeat("s")
        rows = [
            (i, t, "en", s, None if t is None else len(t), "own", 7)
            for i, t, s in zip(ids, texts, sources)
        ]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture()
def table(spark):
    """A table of the sf0.001 inputs."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
