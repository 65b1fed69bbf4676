import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYTHONPATH", ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tideline.session import get_session

    import tempfile

    s = get_session("local[4]", app="tideline-tests", shuffle_partitions=8,
                    extra={"spark.executorEnv.PYTHONPATH": ROOT,
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tl-warehouse-")})
    yield s
    s.stop()


def sensor_df(spark, rows, with_seq=True):
    """rows: (id, ts, vc) in arrival order -> frame with seq = 1, 2, ..."""
    from tideline.schema import SENSOR, SENSOR_SEQ

    if with_seq:
        return spark.createDataFrame([(*r, i + 1) for i, r in enumerate(rows)], SENSOR_SEQ)
    return spark.createDataFrame(rows, SENSOR)
