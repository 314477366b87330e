import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkdesk.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir: the session's own setting when there is one; build_session
    # creates a local folder only when it is unset
    s = build_session("local[4]", 4, app_name="sparkdesk-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sparkdesk-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sparkdesk-test-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
