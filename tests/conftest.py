import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="tidemark-tests")
    yield s
    s.stop()


@pytest.fixture()
def work(spark, request):
    from tidemark.session import new_work_dir
    return new_work_dir(spark, request.node.name[:40])
