import pytest

from acctlens.llm.store import with_code

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_h string, score string, n_lines string, part string, slot string"


@pytest.fixture(scope="session", autouse=True)
def _code_path(spark):
    with_code(lambda s: None)(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "x", "x", "x", "x") for i, t in rows], DOCS)

    return make
