import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import compare as compare_module  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = compare_module.session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return compare_module.connect(FOLDER)


@pytest.fixture(scope="session")
def folder():
    return FOLDER
