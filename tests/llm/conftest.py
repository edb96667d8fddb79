import pytest


@pytest.fixture(scope="session")
def documents_of(spark):
    """A ``documents`` DataFrame from ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` rows, over several partitions."""
    def make(rows, extra=()):
        full = [(*r, *(None,) * (4 - len(r))) for r in rows]
        df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df.repartition(3)

    return make
