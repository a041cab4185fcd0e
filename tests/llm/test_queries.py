import re

import pytest

import __spark_entry__ as contract
from questlog.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import compare, duck


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_\w+$", name)[1]) for name in QUERIES]
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf_dir), QUERIES[name], ORACLE_SQL[name], sf_dir) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    """Every row of the intended table has its result, under the names agreed."""
    sf_dir = "/root/testdata/sf0.001"
    columns = {
        "op1": "doc_id fingerprint component_id", "op2": "doc_id n_words n_removed kept_sha256",
        "op3": "doc_id n_bytes n_tokens over_limit", "op4": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op5": "page_id host path rule verdict", "op6": "doc_id held_out score predicted", "op7": "query_id rank vec_id score",
        "op8": "doc_id piece start length ids_crc32 sequence_id offset",
        "op9": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op10": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op11": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
        "op12": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
        "op13": "doc_id n_lines n_dropped kept_sha256",
    }
    got = QUERIES[name](spark, sf_dir)
    assert got.columns == columns[name.split("_")[0]].split()
    if name.startswith(("op7", "op11", "op12")):
        return
    table, key = ("pages", "page_id") if name.startswith("op5") else ("documents", "doc_id")
    every = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key)
    assert got.select(key).distinct().exceptAll(every).isEmpty() and every.exceptAll(got.select(key).distinct()).isEmpty()
