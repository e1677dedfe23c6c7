import os

import pytest

from cohortgrid.plans import registry

from .oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
#: Iterative queries without SQL that take long; they are tested on small inputs elsewhere.
LONG = {"m7_merge_modules", "m9_eigen_profiles", "m10_membership", "s6_cox_l1_path", "s7_lambda_1se", "s10_capped_signature"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, con, name):
    compare(registry.QUERIES[name](spark, FOLDER), con, registry.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL) - LONG))
def test_runs(spark, name):
    registry.QUERIES[name](spark, FOLDER).count()
