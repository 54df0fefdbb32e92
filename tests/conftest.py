import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="parley-test-")
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "wh"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="parley-run-")


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally projected)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda r: tuple((x is None, 0 if x is None else x) for x in r))
