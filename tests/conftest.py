from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tests.session import build_session

    session = build_session("4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def samples(spark):
    from riskweave.sources import demo

    return demo.samples_table(spark, SF)
