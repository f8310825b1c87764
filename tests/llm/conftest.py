import pytest

from migrascope.llm.common import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) pairs or longer rows."""

    def make(rows, schema=DOCS):
        names = [f.split()[0] for f in schema.split(",")]
        defaults = {"lang": "en", "source": "src0"}
        full = [tuple(r) + tuple(defaults.get(n) for n in names[len(r) :]) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
