import sys

import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Documents (doc_id, text[, lang]) as a table with columns whose names operators use inside."""

    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if extra:
            for name in ("words", "w", "h", "rep", "band", "place", "spans", "component", "score", "n", "ids", "chunk"):
                df = df.withColumn(name, df.source)
        return df

    return make
