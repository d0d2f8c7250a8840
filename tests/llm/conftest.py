import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, verdict int, line string, _key int"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with extra columns whose names clash with those used inside."""
    def make(rows, parts=3):
        rows = [(*r, None, None)[:4] if len(r) < 4 else r for r in rows]
        full = [(i, t, lang, src, None if t is None else len(t), "s", 1, "l", 2) for i, t, lang, src in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make
