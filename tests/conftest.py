import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from kermesse.session import local_session  # noqa: E402

# Column literals are built while test modules load, so the session comes first.
SESSION = local_session()
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
