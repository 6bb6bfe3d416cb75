import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fleetgauge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows("a int, b string", (1, "x"), ...) as a DataFrame."""
    return lambda schema, *values: spark.createDataFrame(list(values), schema)


@pytest.fixture
def write_snapshot():
    def write(root, folder, **feeds):
        target = Path(root) / folder
        target.mkdir(parents=True, exist_ok=True)
        for feed, content in feeds.items():
            text = content if isinstance(content, str) else json.dumps(content, indent=2)
            (target / f"{feed}.json").write_text(text, encoding="utf-8")

    return write
