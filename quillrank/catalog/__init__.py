from quillrank.catalog import (  # noqa: F401
    feature_queries,
    measures,
    model_queries,
    rec,
    report_queries,
    search_queries,
)
from quillrank.catalog.base import ORACLES, QUERIES  # noqa: F401
