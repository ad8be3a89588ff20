import pytest

from starlens.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4, memory="4g")


EXTRA = {"label": "x", "score": 1.5, "bucket": 3, "t": "y", "k": 7}


@pytest.fixture(scope="session")
def table(spark):
    """documents of (doc_id, text) with columns whose names the operators use inside."""

    def make(rows):
        names = ", ".join(f"{c} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'int'}" for c, v in EXTRA.items())
        return spark.createDataFrame([(i, x, *EXTRA.values()) for i, x in rows], f"doc_id long, text string, {names}")

    return make
