import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from settlement_rows import INGESTED, INSTRUMENT_ROWS, INSTRUMENTS_DDL, TRADE_ROWS, TRADES_DDL, at  # noqa: E402

from settleframe.session import local_session  # noqa: E402

@pytest.fixture(scope="session")
def event_log_dir(tmp_path_factory):
    return tmp_path_factory.mktemp("eventlog")


@pytest.fixture(scope="session")
def spark(event_log_dir):
    session = local_session(4, 4, app_name="settleframe-tests", extra={
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": str(event_log_dir),
        "spark.eventLog.compress": "false",
    })
    yield session
    session.stop()


@pytest.fixture
def trades(spark):
    rows = [r[:5] + (at(r[5]), at(r[6]), r[7], INGESTED) for r in TRADE_ROWS]
    return spark.createDataFrame(rows, TRADES_DDL)


@pytest.fixture
def instruments(spark):
    return spark.createDataFrame(INSTRUMENT_ROWS, INSTRUMENTS_DDL)
