"""Every registered query with SQL, compared in DuckDB on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check_oracles  # noqa: E402

from textward.plans import catalog  # noqa: E402


@pytest.fixture(scope="module")
def duck(request):
    return check_oracles.connect("/root/testdata/sf0.001")


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(catalog.all_oracles()))
def test_query_equals_sql(spark, duck, small, name):
    got = catalog.all_queries()[name](spark, small).toPandas()
    want = duck.execute(catalog.all_oracles()[name]).df()
    assert check_oracles.compare(got, want) is None
    assert len(want) > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
