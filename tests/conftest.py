import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from fixture_paths import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from kpiloom.session import get_session
    s = get_session("kpiloom-tests", master="local[*]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="kpiloom-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from kpiloom.testing.compare import duck_views
    con = duckdb.connect()
    duck_views(con, SF_SMALL)
    yield con
    con.close()
