import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)


@pytest.fixture(scope="session")
def spark():
    from glossmill.session import local_session

    session = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def data():
    return os.environ.get("GLOSSMILL_TEST_DATA", "/root/testdata/sf0.001")
