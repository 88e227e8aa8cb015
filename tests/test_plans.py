"""Plan-shape guards for every registered query."""

import pytest

from helpers import SF0001
from skulink.plans.queries import QUERIES

# the same plans as a query that stays in the list
SAME = {"agreement_label", "sentinel_left_outer", "exact_score_band", "last_in_band", "nohit_fallback",
        "cascade_none", "cascade_none_banded", "round_output", "consolidate_by_left",
        "consolidate_by_pair", "right_exclusion", "resume_skip", "assisted_by_name"}
# queries whose construction runs iterative jobs or file writes are checked elsewhere
SKIP = {"cascade_matched", "cascade_last_scanned", "assisted_excluding", "multi_vendor_excluding", "csv_roundtrip", "csv_many_files", "round_files_merge",
        "final_sink", "round_file_count"}


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in SKIP | SAME])
def test_no_pairwise_join_operator(spark, name):
    df = QUERIES[name](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan, name
    assert "BroadcastNestedLoopJoin" not in plan, name
    # parquet scans read only the columns the query needs
    for line in plan.split("\n"):
        if "FileScan parquet" in line and "documents" in line:
            assert "lang" in line or "n_chars" not in line, line
