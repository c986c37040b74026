import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from webloom.functions.language import LanguageModel  # noqa: E402
from webloom.session import local_session  # noqa: E402
from webloom.sources import demo  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8,3", 4)  # a task may fail twice
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def model(spark):
    return LanguageModel.fit(demo.documents(spark, MEDIUM))


@pytest.fixture(scope="session")
def apply(spark):
    """Evaluate a column function on a list of values of one type."""

    def run(function, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        out = df.select("i", function(df.v).alias("r")).collect()
        return [r["r"] for r in sorted(out, key=lambda r: r["i"])]

    return run
