import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TZ", "UTC")

from fieldlark.session import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny():
    if not Path(TINY).exists():
        pytest.skip("no test tables")
    return TINY
