"""Every query has SQL beside it; a few are run here, all of them by tools/check_oracles.py."""

import os
import sys

import pytest
from readings import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402

FEW = ["parse_rejects", "analytics_rejects", "collector_rejects", "collector_crossings", "collector_rolling_means",
       "occupancy_records", "scd41_carry_forward", "scd41_frame_letters", "calibrate_bh1750", "sliding_stats", "rolling_mean_arrival", "threshold_changes", "trend_windows",
       "occupancy_transitions", "late_rows", "carry_forward", "bridge_records", "samples_unpivot",
       "calibrate_dps310", "calibrate_scd41"]


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) == set(entry.ORACLES)
    assert len(entry.QUERIES) > 60
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["carry_forward", "late_rows"])
def test_the_input_is_read_once(spark, name):
    frame = entry.queries()[name](spark, SF_SMALL)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") - plan.count("ReusedExchange") <= 1 and plan.count("FileScan parquet") == 1


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="needs the generated tables")
@pytest.mark.parametrize("name", FEW)
def test_query_against_sql(spark, name):
    import check_oracles

    ok, text = check_oracles.compare(spark, check_oracles.connect(SF_SMALL), name, SF_SMALL)
    assert ok, text
