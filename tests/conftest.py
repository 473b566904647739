import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wayfarer.session import build_session, checkpoint_dir, has_checkpoint_dir

    s = build_session("local[4]", shuffle_partitions=8)
    if not has_checkpoint_dir(s):
        checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="wayfarer-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="wayfarer-test-")
