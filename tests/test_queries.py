"""Every query with SQL against DuckDB, on the smallest tables."""

import pytest
from compare import compare, connect
from conftest import SMALL

import __spark_entry__ as entry_file

QUERIES, SQL = entry_file.queries(), entry_file.oracle_sql()

# Queries whose groups or keys are cut when a group limit is exceeded.
SPLIT = ["days_since_first", "days_since_prior_product", "user_counts", "all_features",
         "recode_table", "enrich", "keep_ids", "delete_matching", "row_weights", "describe",
         "box_stats", "ranked_models", "sorted_values", "segment_runs", "interpolate_linear",
         "interpolate_akima", "rank_symmetric", "trim_runs", "downsample", "sliding_windows",
         "slice_rows", "cumulative_classes", "best_epoch", "subject_zscore", "stratified_folds",
         "sample_per_class", "undersample_split", "proportional_split", "random_split",
         "weighted_resample", "one_class_outliers", "threshold_table", "pr_curve",
         "bag_of_words_lexicon", "tfidf_l2", "doc_vectors"]


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_registry_is_consistent():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) == sum(len(m.plan.queries) for m in entry_file.MODULES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert compare(spark, duck, SMALL, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", SPLIT)
def test_same_with_split_groups(spark, duck, small_groups, name):
    assert compare(spark, duck, SMALL, QUERIES[name], SQL[name]) is None
