import json

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows, with extra columns that clash with results."""

    def make(rows, *extra):
        rows = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCUMENTS)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select(*columns).collect()}


@pytest.fixture(scope="session")
def shown():
    return lambda df: sorted(json.dumps(r.asDict(recursive=True), default=str) for r in df.collect())
