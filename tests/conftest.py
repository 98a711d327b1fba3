import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from medley import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    s = session.build(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": folder,
            "spark.sql.warehouse.dir": folder + "/warehouse",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def same():
    def check(got, want, key=repr):
        a, b = [tuple(r) for r in got.collect()], [tuple(r) for r in want]
        assert sorted(a, key=key) == sorted(b, key=key)

    return check
