import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from codexloom.session import get_session, let_workers_import  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield let_workers_import(session)
    session.stop()
