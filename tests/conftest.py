import sys
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ringtrail import schemas  # noqa: E402
from ringtrail.session import local_session  # noqa: E402
from ringtrail.staging import Staging  # noqa: E402

START = datetime(2022, 9, 1)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "ringtrail-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def stage(spark, tmp_path):
    return Staging(spark, str(tmp_path))


def transfer(txn_id, src, dst, after, amount, currency="Euro", fmt="ACH"):
    """One transfers_to row; `after` is a timedelta from START."""
    return (txn_id, src, dst, START + after, Decimal(str(amount)), currency, fmt)


def hours(n):
    return timedelta(hours=n)


def transfers_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.TRANSFERS_TO)


def raw(after, src, dst, amount, currency="Euro", fmt="ACH", label=0):
    """One transactions_raw row from `bank:account` keys."""
    (fb, fa), (tb, ta) = src.split(":"), dst.split(":")
    value = Decimal(str(amount))
    return (START + after, fb, fa, tb, ta, value, currency, value, currency, fmt, label)


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.TRANSACTIONS_RAW)


def accounts_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.ACCOUNTS_RAW)
