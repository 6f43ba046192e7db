"""Every registered query against its own SQL, at the smallest scale."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES

# They train the full-size models, each its own; test_models trains small ones.
TRAINED = {"train_gradient_boosting", "best_model", "model_predictions"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - TRAINED))
def test_query_agrees_with_its_oracle(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["enrollment_mart", "sponsor_activity", "geo_gaps", "condition_category", "trial_features"])
def test_no_cross_joins(spark, sf_dir, plan, name):
    text = plan(queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_only_used_columns_are_read(spark, sf_dir, plan):
    text = plan(queries()["clean_phase_dist"](spark, sf_dir))
    assert "ReadSchema: struct<props:string>" in text
