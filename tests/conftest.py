import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from claimlens.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    """Interpreted plans: nothing to compile for tiny data, and an error that generated code
    would skip past (a division ahead of its filter) comes out."""
    session = local_session(8, partitions=4)
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


def rows(df):
    """Collected rows as tuples, sorted by text."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
