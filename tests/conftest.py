import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from anaquel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4, memory="4g")


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples, nulls first."""

    def collect(df, *columns):
        selected = df.select(*columns) if columns else df
        key = lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, (list, dict)) else (True, "", str(v)) for v in r)
        return sorted((tuple(r) for r in selected.collect()), key=key)

    return collect
