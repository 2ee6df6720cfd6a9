"""Physical plans of the SQL texts and of the registered queries that stay lazy."""

import pytest

import __spark_entry__
from datamove.checks.common import register
from datamove.checks.transforms import OWN, SHARED

LAZY = [
    "extract_full",
    "extract_keyrange",
    "normalize_types",
    "flatten_structs",
    "changed_rows",
    "align_schemas",
    "merge_upsert",
    "merge_schema_both",
    "merge_latest_per_key",
    "merge_hot_keys",
    "profile_columns",
    "reconcile",
    "audit_differences",
    "resolve_lookups",
    "conditional_lookup",
]
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "BatchEvalPython", "Exchange SinglePartition, REPARTITION")


def assert_sound(text):
    assert not [w for w in UNWANTED if w in text]


@pytest.mark.parametrize("name", LAZY)
def test_queries_avoid_products_and_python(spark, sf_dir, plan, no_broadcast, name):
    assert_sound(plan(__spark_entry__.queries()[name](spark, sf_dir)))


@pytest.mark.parametrize("name", [*SHARED, *OWN])
def test_sql_texts_avoid_products(spark, sf_dir, plan, no_broadcast, name):
    register(spark, sf_dir)
    assert_sound(plan(spark.sql(SHARED[name] if name in SHARED else OWN[name][0])))


def test_ranking_and_top_rows_are_cut_before_the_shuffle(spark, sf_dir, plan):
    register(spark, sf_dir)
    assert plan(spark.sql(SHARED["transform_rank"])).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(spark.sql(SHARED["transform_topk"]))


def test_projection_without_shuffle(spark, sf_dir, plan):
    for name in ("extract_full", "normalize_types", "flatten_structs", "changed_rows", "align_schemas"):
        assert "Exchange" not in plan(__spark_entry__.queries()[name](spark, sf_dir))
