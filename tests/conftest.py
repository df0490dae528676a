import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from sondar.session import local_session

    s = local_session(4, "tests", partitions=4, memory="4g")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark, request):
    from sondar.operators.scratch import Scratch

    return Scratch(spark, request.node.name[:20].replace("[", "-"))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)
