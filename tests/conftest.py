import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8, app_name="quarry-tests")
    yield s
    s.stop()


@pytest.fixture
def write_text(tmp_path):
    """Write lines (str) or raw bytes to a fresh file and return its path."""
    counter = iter(range(10**6))

    def _write(content, name=None):
        p = tmp_path / (name or f"f{next(counter)}.txt")
        if isinstance(content, bytes):
            p.write_bytes(content)
        else:
            p.write_text("\n".join(content) + "\n", encoding="utf-8")
        return str(p)
    return _write
