import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


# Made at import: test modules name columns at their top, which takes a session.
SPARK = (
    SparkSession.builder.master("local[8]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.driver.memory", "8g")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
    .getOrCreate()
)
SPARK.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SPARK
    SPARK.stop()


@pytest.fixture
def texts(spark):
    """A table ``(doc_id, text)`` of the given texts."""

    def make(*values):
        rows = [(i, v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "doc_id long, text string")

    return make


@pytest.fixture
def each(texts):
    """The values of an expression over ``text``, one per given text."""

    def run(expression, *values):
        df = texts(*values).select("doc_id", expression.alias("out"))
        return [r.out for r in sorted(df.collect(), key=lambda r: r.doc_id)]

    return run
