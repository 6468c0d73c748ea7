"""Plan shapes that must hold for every registered query."""

import re

import pytest

import __spark_entry__ as contract
from plan_text import plan_of

SF_DIR = "/root/testdata/sf0.001"
# these end in one row, or in a few rows per calendar day, grid cell, partition or range, by definition
SINGLE_PARTITION = {"global_range", "unique_dates", "dates_by_appearance", "grid_tiles", "pole_map_in_order", "arranged_sheets"}


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_plan(spark, name):
    plan = plan_of(contract.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Python|ArrowEval|InPandas|PandasUDF", plan)
    if name not in SINGLE_PARTITION:
        assert "SinglePartition" not in plan
    assert "FileScan parquet" in plan
    # only the columns a query uses are read
    assert "props" not in plan
