"""Every registered query at the smallest scale, against its SQL where it has one."""

import pytest

from compare import compare, duck
from quillrank.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
# At this scale no title has enough plays and no user enough songs; these run at the next scale as well.
SPARSE = ("default_list", "random_hot", "basket_corpus", "corpus_text")
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name, empty_ok=name in SPARSE) is None


@pytest.mark.parametrize("name", SPARSE)
def test_query_with_rows(spark, name):
    assert compare(spark, duck(LARGER), LARGER, name) is None


def test_registry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert "confidence" in df.columns and df.count() > 0
