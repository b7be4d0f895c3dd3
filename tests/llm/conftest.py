import pytest


@pytest.fixture(scope="session")
def llm(spark):
    from formspark.llm._tables import ready

    return ready(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(llm):
    def make(rows, schema=DOCS):
        n = len(schema.split(","))
        return llm.createDataFrame([tuple(r) + (None,) * (n - len(r)) for r in rows], schema)

    return make
