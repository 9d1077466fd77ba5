import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hearthlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="hearthlake-tests-")
    session = build_session("local[*]", app_name="hearthlake-tests", shuffle_partitions=8,
                            extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def values(df, col=None):
    rows = df.collect()
    if col is None:
        return [tuple(r) for r in rows]
    return [r[col] for r in rows]
