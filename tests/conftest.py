import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from shelfline.session import build_session
    run = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = build_session(master="local[4]", shuffle_partitions=8,
                      checkpoint_dir=os.path.join(run, "ckpt"),
                      extra={"spark.sql.warehouse.dir": os.path.join(run, "warehouse"),
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_table(tmp_path):
    return str(tmp_path / "table")
