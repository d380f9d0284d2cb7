import pytest


@pytest.fixture
def docs(spark):
    """Rows to a documents table; missing members are null."""

    def make(rows):
        names = ("doc_id", "text", "lang", "source", "n_chars")
        return spark.createDataFrame(
            [tuple(r.get(n) for n in names) for r in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        )

    return make
