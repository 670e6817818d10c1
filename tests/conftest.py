from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tools"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session

    return local_session("ledgerline-tests", cores=4)


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).exists():
        pytest.skip("test tables are not available")
    return SMALL
