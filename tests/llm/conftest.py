from __future__ import annotations

import pytest
from cases import EXTRA, SCHEMA, edge_rows


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), *("x" for _ in EXTRA)) for r in edge_rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
