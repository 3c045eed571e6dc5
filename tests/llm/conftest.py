import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]

from llm_rows import ODD  # noqa: E402

SMOKE = "/root/testdata/sf0.001"

@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, None if i is None else f"row{i}", 7, 8, 9) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, fp int, node int, packed int")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
