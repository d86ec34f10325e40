import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lodestrata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {"spark.sql.warehouse.dir": "warehouse", "spark.checkpoint.dir": "checkpoints"}
    session = local_session("tests", **{key: str(tmp_path_factory.mktemp(name)) for key, name in folders.items()})
    yield session
    session.stop()
