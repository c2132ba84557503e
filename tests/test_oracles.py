"""Every query of the base library that has SQL, on the smallest tables; the others must run."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import compare

from voxloom import plans

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_rows_as_sql(name, spark):
    compare(plans.queries()[name], plans.oracle_sql()[name], spark, SF)


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_others_run(name, spark):
    assert plans.queries()[name](spark, SF).count() > 0
