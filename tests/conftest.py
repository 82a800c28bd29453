import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lapgraph.session import get_spark

    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    session = get_spark(
        "tests",
        extra_conf={
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-"),
        },
        log_level="ERROR",
    )
    yield session
    session.stop()
