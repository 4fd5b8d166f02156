import pytest

from tests import oracle


@pytest.fixture(scope="session")
def spark():
    return oracle.session()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def db(sf):
    return oracle.database(sf)


@pytest.fixture
def rows():
    """The rows of a frame as tuples, sorted."""
    return lambda df, *cols: sorted(
        (tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr
    )
