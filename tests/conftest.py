import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")
SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from feedlens.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="feedlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from feedlens.plans.fixtures import BASE_TABLES
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con
