from __future__ import annotations

import sys
from datetime import UTC, datetime
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from estrato.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
RUN_TS = datetime(2025, 1, 1, tzinfo=UTC)


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)
