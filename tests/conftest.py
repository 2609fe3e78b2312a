import os
import sys

import pytest

from given import ARRIVAL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

@pytest.fixture(scope="session")
def spark():
    from feedlake.session import get_session
    s = get_session("local[4]", app="feedlake-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def decode_one(spark):
    """Decode single frames: returns list of (outcome, ts, mt, m) in input order."""
    from feedlake.operators.decode import decode
    from feedlake.schema import RAW_FEED_SCHEMA

    def run(*values, symbol="btc"):
        rows = [(i, symbol, ARRIVAL, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, RAW_FEED_SCHEMA)
        out = decode(df).orderBy("event_id").select("outcome", "ts", "mt", "m").collect()
        return [tuple(r) for r in out]
    return run
