import os
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

import __spark_entry__ as entry
from check_queries import differences, duck
from shopspan.operators.quality import QualityError
from shopspan.plans.flow import RetentionFlow
from shopspan.plans.sample_setting import END_DATE, SAMPLE_PARAMS
from shopspan.schemas import HOUSEHOLD_CHURN_COLUMNS
from shopspan.sources import tables as src

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")

# A cross-section; set ALL_QUERIES=1 to compare every query.
SAMPLE = [
    "household_weeks", "hash_split_train_test", "undersample", "valid_sequences", "horizon_metrics",
    "household_churn", "merge_household_churn",
]


@needs_data
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("ALL_QUERIES") else SAMPLE)
def test_query_equals_sql(spark, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    want = duck(SMALL).execute(entry.oracle_sql()[name]).df()
    assert differences(got, want) == []


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_gate_stops_a_thin_table(spark, tmp_path):
    """A few dozen households leave weeks without any online purchase."""
    tables = src.sales_tables(spark, SMALL)
    flow = RetentionFlow(spark, tables, str(tmp_path / "flow"), SAMPLE_PARAMS)
    with pytest.raises(QualityError, match="avg_n_ecomm_trans_not_0"):
        flow.build_weekly_tables()
    assert not (tmp_path / "flow" / "household_weeks").exists()


@needs_data
def test_flow_end_to_end(spark, tmp_path):
    tables = src.sales_tables(spark, MEDIUM)
    flow = RetentionFlow(spark, tables, str(tmp_path / "flow"), SAMPLE_PARAMS)
    sources = (src.gold_sales(tables.retail_sale), src.gold_customers(tables.dim_customer), src.gold_items(tables.dim_product))
    churn = flow.run(*sources, prediction_date=END_DATE)
    rows = {r.hhn: r for r in churn.collect()}
    assert rows and set(churn.columns) == set(HOUSEHOLD_CHURN_COLUMNS)
    assert all(0 <= r.churn_probability <= 1 for r in rows.values())
    assert {r.candidate for r in flow.read("runs").collect()} == {"overall", "behaviour", "regional", "pooled", "features"}
    assert flow.read("unseen_regions").count() == 0
    # Scoring and merging the same week again changes nothing, not even the files.
    written = {f: f.stat().st_mtime_ns for f in (tmp_path / "flow" / "household_churn").rglob("part-*")}
    flow.predict(END_DATE)
    flow.build_gold(*sources)
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "flow" / "household_churn").rglob("part-*")} == written
    # The same fit against itself: no gap, so the champion stays in use.
    in_use = flow.promoted()
    decided = flow.compare()
    assert decided["n_folds"] == SAMPLE_PARAMS.n_folds and decided["decision"] == "keep"
    assert flow.promoted() == in_use and (decided["candidate"], decided["version"]) == in_use[1:]
    # A later fit on other households does not touch the predictions while the decision is to keep.
    before = {r.hhn: (r.alpha, r.beta) for r in flow.read("churn_output").collect()}
    flow.p = replace(SAMPLE_PARAMS, sample_seed=7, undersample_quantile=0.3, t_test_level=0.0)
    flow.prepare()
    assert flow.fit() == 1
    kept = flow.compare()
    assert kept["decision"] == "keep" and flow.promoted() == in_use
    flow.predict(END_DATE)
    assert {r.hhn: (r.alpha, r.beta) for r in flow.read("churn_output").collect()} == before
    assert not flow.training_is_due() and flow.training_is_due(datetime.now() + timedelta(days=61))
    with pytest.raises(ValueError, match="no run within"):
        flow.compare(datetime.now() + timedelta(days=9))
    with pytest.raises(ValueError, match="future"):
        flow.p = replace(SAMPLE_PARAMS, end_date_pred="2999-01-01")
        flow.predict(END_DATE)
