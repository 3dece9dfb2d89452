import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from biasfit.session import ensure_checkpoint_dir, get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="biasfit-tests", shuffle_partitions=4)
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def mini(spark):
    """Golden mini fixture (FIXTURES.md section 2)."""
    items = spark.createDataFrame(
        [(10, "Alpha (1999)", "Comedy|Drama"), (20, "Beta: Two (2001)", "Action"), (30, "Gamma (2005)", "Comedy|Action")],
        "movieId INT, title STRING, genres STRING")
    train = spark.createDataFrame(
        [(1, 10, 5.0), (1, 20, 3.0), (2, 10, 4.0), (2, 30, 2.0), (3, 20, 1.0), (3, 30, 3.0)],
        "userId INT, movieId INT, rating DOUBLE")
    test = spark.createDataFrame([(1, 30, 4.0), (2, 20, 2.0), (3, 10, 3.5)], "userId INT, movieId INT, rating DOUBLE")
    return items, train, test
