import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sourcetrail.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "sourcetrail-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cases():
    from tests.case_files import load_cases

    return load_cases()


@pytest.fixture(scope="session")
def review(spark, cases):
    """The four cases taken through extraction, findings, classification and the hash chain."""
    from tests.case_files import run_review

    return run_review(spark, cases)
