import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)


@pytest.fixture(scope="session")
def spark():
    from epipanel.session import build_session

    session = build_session(
        "local[4]",
        app_name="epipanel-tests",
        shuffle_partitions=4,
        # tests get their own scratch checkpoint folder only if none is set
        extra_conf={"spark.sql.autoBroadcastJoinThreshold": "10MB"},
    )
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="epipanel-test-ckpt-"))
    yield session


def d(text: str) -> dt.date:
    """``M/d/yy`` or ISO text -> date."""
    from epipanel.operators.series import as_date

    return as_date(text)


def rows(df, *cols):
    """Collected rows as plain tuples of the given columns, in frame order."""
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
