import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surveyspark.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    tmp = tempfile.mkdtemp(prefix="surveyspark-test-")
    s = get_spark("local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": os.path.join(tmp, "ckpt")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="surveyspark-t-")
