import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidecast.session import get_spark
    s = get_spark("tidecast-tests", {
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidecast-test-ckpt-"),
    }, master="local[*]")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as a sorted list of tuples (None for NULL)."""
    cols = order or df.columns

    def norm(v):
        return "NaN" if isinstance(v, float) and v != v else v
    return sorted((tuple(norm(v) for v in r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
