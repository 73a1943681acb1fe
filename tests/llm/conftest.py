import pytest


@pytest.fixture()
def documents(spark):
    """Documents with given fields; missing ones are NULL, and an extra column has a name that operators use inside."""

    def make(*rows):
        names = ("doc_id", "text", "lang", "source", "n_chars", "_measures")
        schema = "doc_id long, text string, lang string, source string, n_chars long, _measures string"
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return make
