"""Plans of the registered queries that do not write their result's inputs first."""

import pytest
from conftest import SF

from ledgerline.llm import queries

LAZY = ["op1_packing", "op2_chat_windows", "op3_decontamination", "op5_warc", "op9_language", "op11_quality_rules", "op13_whitening"]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_and_no_rows_in_one_task(spark, name):
    lines = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        assert "CartesianProduct" not in line and "NestedLoop" not in line
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in lines[i + 1]
