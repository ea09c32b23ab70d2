import pytest

from pricelens.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make(spark):
    """Documents from (id, text) pairs, with the other columns of the table."""
    def run(rows, schema=DOCS):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, schema)
    return run
