import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerlake.session import build_session
    work = tmp_path_factory.mktemp("work")
    # spark.checkpoint.dir is left to the environment; the layers go to a
    # per-session subfolder of it (see ledgerlake.session.shared_dir)
    session = build_session("local[4]", app_name="ledgerlake-tests", extra={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": str(work / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from ledgerlake.plans.lakehouse import Lakehouse
    return Lakehouse.of(spark, SF001)
