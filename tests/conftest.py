from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from content_signals.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def column(spark):
    """Evaluate a column function on one-column text rows, in the given order."""
    from pyspark.sql import functions as F

    def evaluate(fn, values):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i bigint, v string")
        return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return evaluate


@pytest.fixture
def table(spark):
    """Rows of dicts as a DataFrame of text columns with ``_ord``."""
    from content_signals.constants import ORD

    def build(rows, **types):
        names = list(rows[0])
        schema = ", ".join(f"{n} {types.get(n, 'string')}" for n in names) + f", {ORD} bigint"
        return spark.createDataFrame([(*r.values(), i) for i, r in enumerate(rows)], schema)

    return build
