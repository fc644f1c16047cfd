import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents table of (doc_id, text, lang, source) rows, or of texts alone."""

    def make(rows, schema=DOCS):
        full = []
        for k, r in enumerate(rows):
            r = (k, r) if r is None or isinstance(r, str) else r
            r = (*r, *("en", "src0")[len(r) - 2 :]) if len(r) < 4 else r
            full.append((*r, len(r[1]) if r[1] is not None else None))
        return spark.createDataFrame(full, schema)

    return make
