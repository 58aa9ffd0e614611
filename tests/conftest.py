import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from losslens.session import get_spark
    s = get_spark("local[4]", 4, app="losslens-tests",
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="losslens-test-ckpt-"),
                         "spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
