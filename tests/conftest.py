import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tideline.session import local_session
    yield local_session("8", "tests")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def slots(spark):
    """make(rows, names): a frame with zone, time_6h from slot numbers and the given values."""
    import datetime as dt

    def make(rows, names, start=dt.datetime(2024, 1, 1)):
        data = [(z, start + dt.timedelta(hours=6 * n), *rest) for z, n, *rest in rows]
        kinds = {float: "double", int: "int", str: "string"}

        def kind(i):
            seen = [r[i + 2] for r in rows if r[i + 2] is not None]
            return kinds[type(seen[0])] if seen else "double"

        schema = "zone string, time_6h timestamp_ntz" + "".join(
            f", {n} {kind(i)}" for i, n in enumerate(names))
        return spark.createDataFrame(data, schema)
    return make
