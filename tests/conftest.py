import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starledger.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    extra = {"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    s = build_session(master="local[*]", shuffle_partitions=8, extra=extra)
    checkpoint_dir(s)  # the session's shared folder, or a private one when unset (tests)
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as sorted tuples (order-insensitive comparison)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
