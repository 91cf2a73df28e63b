"""The registered queries against their SQL at the smallest scale."""

import re

import pytest
from compare import differences

from harvestline.llm.oracle import ORACLE
from harvestline.llm.queries import QUERIES

#: Training, tokens, alignment, unusual hashes and match places are beyond SQL.
BRUTE_FORCE_ONLY = {
    "op3_pii", "op4_simhash", "op5_hmm", "op6_toxicity", "op8_packing", "op9_decontaminate",
    "op13_quality",
}


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) - set(ORACLE) == BRUTE_FORCE_ONLY
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    result = differences(found, sf_dir, ORACLE[name])
    may_be_empty = ("op7_licenses", "op12_collocations")  # the table is very small
    assert result is None or (result == "empty result" and name in may_be_empty)


@pytest.mark.parametrize("name", sorted(BRUTE_FORCE_ONLY - {"op9_decontaminate"}))
def test_query_has_a_row_for_every_document_at_least(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES[name](spark, sf_dir)
    assert found.select("doc_id").distinct().count() == docs.count()
