import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(
        master="local[4]",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerlens-tests-")},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def ledger(spark):
    from ledgerlens.sources.ledger import ledger_for

    return ledger_for(spark, SF_SMALL)
