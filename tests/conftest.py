import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from jobsmith.session import build_session
    s = build_session("local[*]", 8, app="jobsmith-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="jobsmith-test-")})
    yield s
    s.stop()


def rows(df, *cols):
    return [tuple(r[c] for c in cols) if cols else r.asDict() for r in df.collect()]
