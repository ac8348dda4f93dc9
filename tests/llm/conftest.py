import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples, with the other columns."""

    def make(rows, extra=""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        ddl = "doc_id long, text string, lang string, source string, n_chars long"
        docs = spark.createDataFrame(full, ddl)
        for name in extra.split():
            docs = docs.selectExpr("*", f"'x' as `{name}`")
        return docs

    return make
