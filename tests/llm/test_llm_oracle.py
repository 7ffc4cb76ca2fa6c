"""Every llm query with a DuckDB statement, row by row."""

import pytest
from oracle_check import compare, duck

from trafficwatch.llm import oracle, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_only_unexpressible_queries_lack_a_statement():
    assert set(queries.registry()) - set(oracle.registry()) == {"op1_chat_repair", "op2_packing", "op9_wavelet_tokens", "op10_lang_crf", "op11_quality_gam"}


@pytest.mark.parametrize("name", sorted(oracle.registry()))
def test_query_matches_statement(spark, con, name):
    ok, said = compare(queries.registry()[name](spark, SF), con, oracle.registry()[name])
    assert ok, f"{name}: {said}"
