"""Queries over nested requirements deal their rows to partitions by their number, so no task's memory grows with the tables."""

import re

import pytest

from docfold.plans import ORACLE, QUERIES
from docfold.sources import tables
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["explode_obligations", "struct_merge", "full_analysis", "full_mapping"])
def test_partitions_grow_with_rows(spark, monkeypatch, name):
    con = connect(SF)
    rows = con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    for a_task in (rows // 40, rows // 80):
        monkeypatch.setattr(tables, "ROWS_A_TASK", a_task)
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        dealt = re.findall(r"hashpartitioning\(requirement_id#\d+L, (\d+)\), REPARTITION_BY_NUM", plan)
        assert dealt and all(int(n) >= rows / a_task for n in dealt)
        assert not re.search(r"hashpartitioning\(requirement_id#\d+L, \w+#", plan)  # and nothing is dealt again by more keys
    same(spark, con, QUERIES[name], ORACLE[name], SF)
