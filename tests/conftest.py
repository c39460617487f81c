import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from chartframes.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from checks.registry import Tables

    return Tables(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def built(spark):
    """Every query of the checks on the smallest tables, built once."""
    import __spark_entry__  # noqa: F401  registers the checks
    from checks import registry

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return {name: query(spark, "/root/testdata/sf0.001") for name, query in registry.queries().items()}


def rows(df, *names):
    """Collected rows as a sorted list of tuples."""
    found = (df.select(*names) if names else df).collect()
    return sorted((tuple(r) for r in found), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])
