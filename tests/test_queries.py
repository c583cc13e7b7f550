"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.comparison import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RUNS, ORACLES = queries(), oracle_sql()
# Writing some two thousand date folders takes most of a minute; RUN_SLOW=1 includes these.
SLOW = {
    "k2_gathered_write", "k3_dynamic_overwrite", "k14_clustered_write", "m1_merge_into_table", "m3_merge_partition",
    "m4_incremental_fact", "m7_late_data_scenario", "m8_incremental_run", "u4_inventory_difference", "p3_etl_table",
}


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query_equals_its_sql(spark, database, name):
    if name in SLOW and not os.environ.get("RUN_SLOW"):
        pytest.skip("writes many date folders; set RUN_SLOW=1")
    problem = difference(RUNS[name](spark, SF_DIR), ORACLES.get(name), database)
    assert problem is None or problem.startswith("rows only"), problem


def test_flagship(spark):
    assert entry(spark).count() > 0
