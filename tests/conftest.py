import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app="tidemark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def bronze(spark):
    from tidemark.sources.bronze import from_fixtures
    return from_fixtures(spark, SF_SMALL)


@pytest.fixture(scope="session")
def thresholds(spark):
    from tidemark.operators.joins import upper_columns
    from tidemark.sources.fixtures import RECIPES
    return upper_columns(spark.sql(RECIPES["config_milestone_status"]))
