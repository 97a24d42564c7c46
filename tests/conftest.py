import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from touchline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="touchline-tests-")
    session = local_session(
        os.environ.get("TEST_CPUS", "4"),
        4,
        **{
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.checkpoint.dir": f"{folder}/shared",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
