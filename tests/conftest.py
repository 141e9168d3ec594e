import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidedesk.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark import SparkConf

    extra = {}
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = str(tmp_path_factory.mktemp("checkpoints"))
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", **extra},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TICKET = {
    "ticket_id": "0b9d6c55-7e21-4f0a-a1c4-5d2e8f7a9b30", "created_at": "2023-11-07T16:45:12Z",
    "customer_id": "c-5081", "channel": "web", "subject": "Printer stays offline",
    "body": "Since the update it prints nothing at all.", "priority": "medium", "category": "technical",
    "status": "open", "agent_id": "desk-17",
}


@pytest.fixture
def make_tickets(spark):
    """Raw ticket rows: one valid ticket per dict, overridden by it."""

    def make(*overrides, **same):
        names = [*TICKET, "row_seq"]
        rows = [{**TICKET, "row_seq": i, **same, **o} for i, o in enumerate(overrides or [{}])]
        schema = ", ".join(f"{n} {'long' if n == 'row_seq' else 'string'}" for n in names)
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)

    return make
