"""Physical plans stay what they should be: few shuffles, pruned columns, pushed filters, no single-task windows."""

import re

import pytest

from cardsentry.operators import profile as PR
from cardsentry.operators import quality as Q
from cardsentry.operators.features import FeatureStore
from cardsentry.operators.split import TimeSplit
from cardsentry.operators.transaction import stateless_columns
from cardsentry.operators.velocity import velocity_features
from cardsentry.sources.tables import transactions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hashp|rangep|SingleP|RoundR)", plan(df)))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    transactions(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def test_velocity_is_one_shuffle_and_one_sort(stored):
    df = velocity_features(stored, 1.0)
    assert shuffles(df) == 1
    assert plan(df).count("Sort [") == 1


def test_stateless_features_do_not_shuffle(stored):
    df = stored.select("trans_num", *[x.alias(c) for c, x in stateless_columns(stored).items()])
    assert shuffles(df) == 0


def test_feature_matrix_shuffles_only_for_the_card_history(stored):
    df = FeatureStore.fit(stored).transform(stored)
    assert shuffles(df) == 1
    assert "job#" not in re.search(r"FileScan parquet \[([^\]]*)\]", plan(df)).group(1)


def test_split_parts_reach_the_scan_as_filters(stored):
    first, second, third = TimeSplit.fit(stored).parts(stored)
    for part in (first, second, third):
        scan = plan(part.select("amt"))
        assert re.search(r"PushedFilters: \[[^\]]*trans_date_trans_time", scan), scan
        assert "struct<trans_date_trans_time:timestamp,amt:double>" in scan


def test_rates_read_two_columns_and_combine_before_the_shuffle(stored):
    text = plan(PR.fraud_by(stored, "merchant", "merchant"))
    assert "ReadSchema: struct<merchant:string,is_fraud:int>" in text
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")  # below the exchange


def test_dedup_combines_before_the_shuffle(stored):
    text = plan(Q.dedup_first(stored, "cc_num", "event_id"))
    assert "partial_min_by" in text and "Window" not in text


def test_top_rates_is_a_bounded_top_k(stored):
    assert "TakeOrderedAndProject" in plan(PR.top_rates(stored, "state"))


def test_null_profile_is_one_pass(stored):
    assert shuffles(Q.null_profile(stored)) == 1
    assert plan(Q.null_profile(stored)).count("FileScan") == 1


def test_class_counts_window_sees_one_row_per_class(stored):
    text = plan(PR.class_counts(stored))
    assert text.index("Window") < text.index("HashAggregate")
