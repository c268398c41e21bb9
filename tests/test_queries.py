"""Every registered query runs; every one with SQL agrees with another engine."""

import pytest

import __spark_entry__ as registered
import workloads
from tests.compare import difference
from workloads.registry import ORACLES, QUERIES

workloads.load_all()
# Model fits are tested with invariants in test_models.
FITS = {
    "fit_logreg", "fit_rf", "fit_logreg_multiclass", "cv_metrics", "predictions", "fit_report",
    "predict_saved_model", "feature_importance",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - FITS))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert registered.entry(spark).columns == ["churned", "count"]
