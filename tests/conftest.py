import os

import pytest

from tidemark.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Lost tasks are tried again, as on a cluster.
    settings = {
        "spark.checkpoint.dir": f"file:{tmp_path_factory.mktemp('shared')}",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }
    session = build_session("tests", "local[8,4]", 8, settings)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def put(folder, relpath, content=b"x", mtime=1_000_000_050):
    """A file with a time of its own."""
    path = folder / relpath
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
    os.utime(path, (mtime, mtime))
    return path


@pytest.fixture
def folders(tmp_path):
    """Source, target, archive and state folders."""
    for name in ("in", "out", "done"):
        (tmp_path / name).mkdir()
    return tmp_path
