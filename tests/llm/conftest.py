import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from carelens.llm.shipping import ship  # noqa: E402


@pytest.fixture(autouse=True)
def on_workers(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def build(rows):
        frame = spark.createDataFrame(list(rows), "doc_id long, text string")
        names = ("lang", "source", "pos", "line", "key", "fingerprint", "slot", "label", "n_lines", "length", "window")
        return frame.selectExpr("*", *(f"'x' AS {name}" for name in names))

    return build
