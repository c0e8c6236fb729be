import os
import sys
import tempfile
from contextlib import contextmanager

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from svcvitals.session import build_session, ship_package
    s = build_session("local[4]", shuffle_partitions=8, app_name="svcvitals-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="svcvitals-test-ckpt-"))
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="svcvitals-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@contextmanager
def many_partitions(spark):
    """Small test data keep their shuffle partitions, as large data would."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, old)
