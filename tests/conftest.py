from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from rivulet.session import build_session

    # Local test runs: a private checkpoint folder only because none is configured.
    s = build_session("local[*]", shuffle_partitions=8, app_name="rivulet-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rivulet-tests-"))
    yield s
    for q in s.streams.active:
        q.stop()
    s.stop()


@pytest.fixture()
def conf(spark):
    """Set session confs for one test and restore them afterwards."""
    saved = {}

    def set_(key, value):
        if key not in saved:
            saved[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield set_
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
