import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        app="tests", checkpoint_dir=str(tmp_path_factory.mktemp("shared")), memory="6g"
    )
    yield session
    session.stop()


@pytest.fixture
def many_chunks(spark):
    """Keep small range partitions apart, so that split groups have many seams."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)
