import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martflow.session import get_session
    s = get_session("local[4]", 4, app_name="martflow-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="martflow-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from martflow.session import work_dir
    return work_dir(spark, "t")
