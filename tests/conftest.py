import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillpanel.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tillpanel-test-")


FIRST_WEEK = "2031-03-07"  # a Friday


def week_sales(store, week):
    """Sales of the made-up panel: a sawtooth over the weeks, at another height for every store."""
    return 700.0 * store + 130.0 * week + 45.0 * (week % 3)


def toy_panel(spark, stores=(1,), weeks=10, start=FIRST_WEEK, sales=week_sales):
    """Weekly rows without gaps for every store; the indicators drift with the week."""
    import datetime as dt
    from tillpanel.sources.panel import PANEL_SCHEMA
    first = dt.date.fromisoformat(start)
    rows = [(s, first + dt.timedelta(weeks=w), sales(s, w), int(w % 6 == 5), 41.5 + w % 9, 3.0 + w / 64, 180.0 + s, 6.25 + s / 8)
            for s in stores for w in range(weeks)]
    return spark.createDataFrame(rows, PANEL_SCHEMA)
