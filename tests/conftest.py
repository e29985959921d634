import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from dossier.session import checkpoint_dir, get_session
    s = get_session("local[4]", app_name="dossier-tests", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="dossier-warehouse-")})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s, tempfile.mkdtemp(prefix="dossier-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="dossier-test-")
