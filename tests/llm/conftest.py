import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows, **clashing):
        full = [(*r, "en", "s")[:2] + ((r[2], r[3]) if len(r) > 2 else ("en", "s")) for r in rows]
        full = [(*r, None if r[1] is None else len(r[1])) for r in full]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name, value in clashing.items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make


def by_id(df):
    """Rows by doc_id; a doc_id that repeats keeps its last row."""
    return {row["doc_id"]: row for row in df.collect()}
