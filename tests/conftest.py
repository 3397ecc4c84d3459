import gzip as gz
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sluice import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    spark = session.local_session(
        8,
        **{
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.checkpoint.dir": str(work / "checkpoints"),
            "spark.driver.memory": "4g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def put(tmp_path):
    """Write a text file below the test's folder, gzipped if it is named so; gives its path."""

    def write(name: str, text: str) -> str:
        path = tmp_path / name
        os.makedirs(path.parent, exist_ok=True)
        data = text.encode("utf-8")
        path.write_bytes(gz.compress(data) if name.endswith(".gz") else data)
        return str(path)

    return write


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
