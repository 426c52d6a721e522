import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))
sys.path.insert(0, os.path.join(ROOT, "tests"))

from small_inputs import SMALL_SF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session

    s = local_session("*", 8, app="quarry-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    from oracle_check import duck_con

    return duck_con(SMALL_SF)
