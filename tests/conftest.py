import pytest

from tests.agree import session


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))

    return collect
