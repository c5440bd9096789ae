import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quillrank.session import local_session

    session = local_session(8, partitions=4, memory="6g")
    if not session.sparkContext.getConf().get("spark.checkpoint.dir", ""):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture()
def rows():
    """Collected rows as a sorted list of tuples."""

    def collect(df, *columns):
        return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())

    return collect
