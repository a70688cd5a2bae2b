import os
import sys

import pytest
from pyspark.sql.types import IntegerType, StructField, StructType

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from orderlens.schemas import ORDER  # noqa: E402
from orderlens.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("orderlens.work.dir", str(tmp_path_factory.mktemp("work")))
    yield session
    session.stop()


@pytest.fixture
def orders(spark):
    """Order rows from tuples; rows are numbered in ``seq`` as they arrive."""
    def build(*rows):
        schema = StructType([*ORDER, StructField("seq", IntegerType())])
        return spark.createDataFrame([(*row, n) for n, row in enumerate(rows)], schema)

    return build
