import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from mercadia.session import configure
    builder = (SparkSession.builder.master("local[*]").appName("mercadia-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    configure(s)  # sets a temporary checkpoint folder only if the session names none
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="mercadia-test-")


def make(spark, table, rows):
    """Source table from partial dict rows (missing columns → NULL)."""
    from mercadia.sources.schemas import SOURCE_SCHEMAS
    schema = SOURCE_SCHEMAS[table]
    data = [tuple(float(v) if isinstance(v := r.get(f.name), Decimal) else v for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)
