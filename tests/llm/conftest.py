import pytest

from daymatrix.llm import queries

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    queries.ship(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with columns whose names
    the operators use themselves."""

    def build(rows):
        whole = [(*r, None)[:3] for r in rows]
        df = spark.createDataFrame([(i, t, c, None, None) for i, t, c in whole], DOCS)
        for name in ("label", "score", "rules", "fp", "Pair", "copy", "stats", "n", "salt", "length"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build
