import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from barlab.session import local_session

    session = local_session("*", shuffle_partitions=8, app="barlab-tests")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barlab-ckpt-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_sf001():
    from oracle_compare import duck

    return duck(SF001)


@pytest.fixture
def make_bars(spark):
    """Bars from literal rows ``(ticker, 'YYYY-MM-DD', open, close)`` or with
    all six prices; missing prices default from open/close."""
    import datetime as dt

    from barlab.schema import BARS

    def build(rows):
        out = []
        for r in rows:
            t, d, *p = r
            if len(p) == 2:
                o, c = p
                p = [o, None if o is None or c is None else max(o, c), None if o is None or c is None else min(o, c), c, c, 1.0]
            out.append((t, dt.date.fromisoformat(d), *[None if v is None else float(v) for v in p]))
        return spark.createDataFrame(out, BARS)

    return build
