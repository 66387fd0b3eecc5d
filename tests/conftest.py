import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_CHECK = os.environ.get("FIELDLENS_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def sf_check():
    return SF_CHECK


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from fieldlens.session import get_session
    s = get_session("local[4]", app="fieldlens-tests", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="fieldlens-warehouse-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from fieldlens.sources.fixtures import RAW_TABLES
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    return con
