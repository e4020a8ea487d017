import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from helpers import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return oracle.session()


@pytest.fixture(scope="session")
def tables(spark):
    from cartwake.queries import Tables

    return Tables(spark, SMALL)


@pytest.fixture(scope="session")
def skewed(spark, tables):
    """Click view in which one session holds a third of all rows."""
    from pyspark.sql import functions as F

    c = tables.carts
    small = F.col("session_id").isin("s1", "s2", "s3", "s4", "s5")
    return c.withColumn("session_id", F.when(small, "s1").otherwise(F.col("session_id"))).cache()


@pytest.fixture(scope="session")
def hot_layout(skewed):
    from cartwake.layout import profile_sessions

    layout = profile_sessions(skewed, hot_rows=150, segment_rows=20, fraction=1.0, max_segments=64)
    assert layout.hot
    return layout


@pytest.fixture(scope="session")
def tiny_layout(skewed):
    """About three rows in a segment, so most lack some kind of event."""
    from cartwake.layout import profile_sessions

    return profile_sessions(skewed, hot_rows=150, segment_rows=2, fraction=1.0, max_segments=128)
