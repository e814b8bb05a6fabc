"""Folders of the shared test tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def sf_small() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def sf_middle() -> str:
    return str(DATA / "sf0.01")
