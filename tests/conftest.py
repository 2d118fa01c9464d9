import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__sql__shuffle__partitions="4"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return lambda label: str(tmp_path / f"{label}-{uuid.uuid4().hex[:8]}")
