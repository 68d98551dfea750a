from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if path not in sys.path:
        sys.path.insert(0, path)

from starfold.plans.store import Store  # noqa: E402
from starfold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    # Tiny inputs: compiling a stage takes longer than running it.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))
