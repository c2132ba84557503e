"""The operators' queries that have SQL, on the smallest tables; the others must run over all rows."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from oracle import compare

from voxloom.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(name, spark):
    compare(registry.queries()[name], registry.oracle_sql()[name], spark, SF)


@pytest.mark.parametrize("name", ["op5_private_data", "op6_sharding", "op8_quality_rules", "op9_language_model"])
def test_one_row_for_each_document(name, spark):
    assert registry.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
