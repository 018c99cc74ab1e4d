import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadlake.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.log.level": "ERROR",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame(schema, row, row, …)"""

    def make(schema, *rows):
        return spark.createDataFrame([tuple(r) if isinstance(r, (tuple, list)) else (r,) for r in rows], schema)

    return make


def values(df, *columns):
    """Rows as plain tuples, in their order."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def details(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
