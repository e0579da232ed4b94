from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quarry.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, 4, "3g", **{"spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
