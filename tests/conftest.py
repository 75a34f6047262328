import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from reqmill.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="8", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g"})
    ship_package(session)
    yield session
    session.stop()
