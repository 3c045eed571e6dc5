import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from marginflow.session import build_session

    session = build_session("local[4]", shuffle_partitions=8, app_name="marginflow-tests")
    # Tests run without a cluster: register our own checkpoint folder (never on a cluster).
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marginflow-test-"))
    yield session
    session.stop()


SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def published(spark):
    """One rebuild that several tests look at: (folder, paths)."""
    from marginflow.plans import pipeline

    out = tempfile.mkdtemp(prefix="mf-run-")
    return out, pipeline.run(spark, SMOKE, out)
