import pytest

import __spark_entry__ as entry
from compare import DATA, compare

CORE = sorted(k for m in entry._CORE for k in m.QUERIES)


@pytest.mark.parametrize("name", CORE)
def test_query_beside_sql(spark, name):
    r = compare(spark, name, f"{DATA}/sf0.001")
    assert r["ok"] is not False, r


def test_entry(spark):
    assert entry.entry(spark).columns
