"""Every registered query of the subpackage has DuckDB SQL or a named test against
brute force, an exact round trip or bounds; those with SQL are run against it."""
import inspect

import duckdb
import pytest
from conftest import SMALL

import test_operators
import test_pipeline
from tidemark.llm import queries

BY_TEST = {
    "op1_source_mixing": test_operators.test_op1_targets_and_taken,
    "op2_quality_rules": test_operators.test_op2_counts_and_verdict,
    "op3_sharding": test_operators.test_op3_shards,
    "op4_license_scan": test_operators.test_op4_brute_force,
    "op5_line_dedup": test_operators.test_op5_removed_lines,
    "op7_best_fit_packing": test_pipeline.test_op7_brute_force,
    "op8_substring_dedup": test_operators.test_op8_spans,
    "op9_ngram_jaccard": test_operators.test_op9_components,
    "op10_token_output": test_operators.test_op10_round_trip,
    "pipeline": test_pipeline.test_stages_follow_each_other,
}


def test_every_query_has_sql_or_a_test():
    assert set(queries.ORACLE) | set(BY_TEST) == set(queries.QUERIES)
    assert not set(queries.ORACLE) & set(BY_TEST)
    assert all(inspect.isfunction(f) and f.__name__.startswith("test_") for f in BY_TEST.values())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SMALL)
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)
