import re
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry_module
from shelfwise.plans.registry import REGISTRY
from shelfwise.plans.views import Views

SMALL = "/root/testdata/sf0.001"
# The only queries that may start Python workers.
PYTHON_QUERIES = {"D03_similar_keys"}
# These run jobs of their own while they are built.
EAGER = {
    "A01_read_catalog", "A01_reviews_and_rejects", "A02_stage_round_trip", "A09_loads_once", "A10_bucketed_upsert", "C16_standardize",
    "C16_stored_rules", "K02_block_search", "K02_block_soft_price", "K03_english_exclusion", "K03_english_phrase", "K10_filtered_count",
    "K10_filtered_facets", "K11_complete_stored", "K11_page_after", "K13_sketch_rollup", "X01_metrics_stream", "X01_sketch_stream",
    "X02_live_profile", "X02_standardize_stream",
}


def test_entry_has_one_row_per_product(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["product_id", "n_offers", "n_kept", "target_price"] and df.count() > 0


def test_every_query_has_a_builder_and_sql():
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries) and set(REGISTRY.queries) <= set(sql)


def test_rest_works_without_the_corpus_subpackage():
    script = (
        "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
        "assert 'P02_consensus_price' in e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())"
    )
    subprocess.run([sys.executable, "-c", script], check=True, cwd=Path(entry_module.__file__).parent)


def test_stored_index_is_pruned_by_category_and_term(spark):
    views = Views(spark, SMALL)
    plan = REGISTRY.queries["K02_smart_search"].build(views)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(category_id#\d+L\), \(category_id#\d+L = 2\)\], PushedFilters: \[In\(term, \[widget,yes\]\)", plan)
    built = REGISTRY.queries["K01_build_index"].build(views)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in built


def test_plans_stay_in_the_jvm_and_avoid_products(spark):
    views = Views(spark, SMALL)
    for name, query in REGISTRY.queries.items():
        if name in EAGER:
            continue
        plan = query.build(views)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert bool(re.search(r"Python|Pandas", plan)) == (name in PYTHON_QUERIES), name


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry_module.queries()["K11_lookup"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49.0)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_rankings_keep_few_rows_per_group_before_the_shuffle(spark):
    for name in (
        "D01_analyze_keys", "D06_key_report", "G07_review_corpus", "H02_select_source", "H05_pick_links", "H06_score_documents",
        "H10_pick_review_source", "K05_common_features",
    ):
        plan = entry_module.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan, name
