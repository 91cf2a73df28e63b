"""Every registered query against its SQL at the smallest scale."""

import pytest
from compare import differences

from __spark_entry__ import entry, oracle_sql
from harvestline.plans.oracle import ORACLE
from harvestline.plans.registry import REGISTRY

MODEL = {"rf_train", "rf_cv", "rf_importance", "rf_predictions"}
ROWS_ONLY = MODEL


def test_only_unrepeatable_queries_go_without_sql():
    assert set(REGISTRY) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(REGISTRY)
    assert set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(REGISTRY[name](spark, sf_dir), sf_dir, ORACLE[name]) is None


def test_entry_has_the_feature_columns(spark):
    frame = entry(spark)
    assert frame.columns == [
        "county_id", "date", "avg_temp", "total_precip", "gdd", "avg_ndvi",
        "ndvi_lag1", "ndvi_lag2", "precip_lag1", "temp_lag1",
    ]
    assert not frame.isEmpty()


def test_sampled_scaling_grows_to_the_whole_table(spark, sf_dir):
    rows = {r.fraction: r.row_count for r in REGISTRY["sampled_scaling"](spark, sf_dir).collect()}
    counts = [rows[f] for f in sorted(rows)]
    assert counts == sorted(counts)
    assert counts[-1] == 6000
    assert 0.05 < rows[0.1] / 6000 < 0.15
