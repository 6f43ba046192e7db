"""Every training-data query that SQL can express against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from cohortmill.llm.oracles import ORACLES
from cohortmill.llm.queries import QUERIES

# Models, fingerprints and token ids; tested by brute force, round trips and held-out rows.
NO_SQL = {
    "op1_quality_classifier",
    "op4_toxicity",
    "op5_simhash",
    "op7_packing",
    "op8_benchmark_decontamination",
    "op11_token_alignment",
}


def test_names():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_oracle(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_every_row_is_scored(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in sorted(NO_SQL - {"op7_packing", "op8_benchmark_decontamination"}):
        got = QUERIES[name](spark, sf_dir)
        assert got.count() == n == got.select("doc_id").distinct().count(), name
