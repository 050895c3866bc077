import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cohortlens.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="cohortlens-tests", driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from cohortlens.sources.testdata import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
