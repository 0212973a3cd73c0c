import pytest


@pytest.fixture(autouse=True)
def _workers(spark):
    from corpusprep.session import share_package

    share_package(spark)


@pytest.fixture()
def table(spark):
    """A documents-like frame from (doc_id, text) rows, with extra columns whose names operators use too."""

    def make(rows, parts=3):
        full = [(i, t, "en", 1, 2, True) for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, n bigint, row bigint, keep boolean").repartition(parts)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    """(doc_id, text) of the smallest documents table."""
    return [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]


#: Nulls, empty and blank texts, ties, repeated rows, null ids, a long text.
ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "a null id"), (5, "tie tie tie"), (5, "tie tie tie"), (6, "tie tie tie"),
       (7, "one"), (8, "é漢😀 \x85 \xa0 x"), (9, "long " * 60_000), (None, None)]


@pytest.fixture()
def odd():
    return list(ODD)
