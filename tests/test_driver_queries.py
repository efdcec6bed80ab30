import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_module
import oracle
from solarspark.plans.driver_oracle import ORACLE
from solarspark.plans.driver_queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")



@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_sql_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    df, relation = QUERIES[name](spark, SF_DIR), con.sql(ORACLE[name])
    assert oracle.type_difference(df, relation) == {}
    assert oracle.difference(df.toPandas(), relation.df()) is None


def test_entry(spark):
    assert sum(r["count"] for r in entry_module.entry(spark).collect()) == 6000


def test_comparison_notices_a_changed_value(con):
    frame = con.sql("SELECT r_regionkey, r_name FROM region").df()
    changed = frame.copy()
    changed.loc[2, "r_name"] = "elsewhere"
    assert oracle.difference(frame, frame.sample(frac=1, random_state=1)) is None
    assert "r_name" in oracle.difference(frame, changed)
    assert "rows" in oracle.difference(frame, frame.head(3))
