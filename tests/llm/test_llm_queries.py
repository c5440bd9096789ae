"""Every registered query of the subpackage at the smallest scale, against its SQL where it has one."""

import pytest

from compare import duck, normal
from corpus_pipeline import QUERIES as PIPELINE
from quillrank.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    columns, got = normal(df.columns, df.collect())
    assert got
    if name in ORACLES:
        cursor = duck(FOLDER).execute(ORACLES[name])
        assert (columns, got) == normal([d[0] for d in cursor.description], cursor.fetchall())


def test_entry_lists_them():
    import __spark_entry__ as entry

    assert set(QUERIES) | set(PIPELINE) <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
