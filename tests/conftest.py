import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from clientcurve import schemas as S  # noqa: E402
from clientcurve.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="clientcurve-tests")
    yield s
    s.stop()


@pytest.fixture
def mk(spark):
    """Build a DataFrame from rows and a DDL schema string."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def orgs_df(spark):
    def make(rows):
        """rows: dicts with any subset of the orgs columns."""
        full = [tuple(r.get(f.name) for f in S.ORGS.fields) for r in rows]
        return spark.createDataFrame(full, S.ORGS)

    return make


@pytest.fixture
def invoices_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, S.INVOICES)

    return make


D = dt.date
