import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cinespark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="cinespark-test-")
    s = build_session("local[4]", 8, extra={"spark.local.dir": scratch,
                                            "spark.driver.memory": "6g",
                                            "spark.checkpoint.dir": f"{scratch}/ckpt"})
    yield s
