import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture
def docs(spark):
    def make(rows, extra=""):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + extra
        return spark.createDataFrame([(*r, *[None] * (5 - len(r))) if not extra else r for r in rows], schema)

    return make
