"""Splitting, sampling, preprocessing, quality."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import preprocess as P
from cardsentry.operators import quality as Q
from cardsentry.operators.split import TimeSplit, stratified_sample
from cardsentry.session import materialise
from tests.test_features import sample

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def timed(spark, seconds, label=0):
    rows = [(f"t{i:04d}", T0 + timedelta(seconds=s), label) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "trans_num string, trans_date_trans_time timestamp, is_fraud int")


def test_split_sizes_and_no_leak(spark):
    df = timed(spark, range(20))
    first, second, third = TimeSplit.fit(df).parts(df)
    assert (first.count(), second.count(), third.count()) == (14, 3, 3)
    top = lambda d, f: d.agg(f("trans_date_trans_time")).first()[0]
    assert top(first, F.max) < top(second, F.min) and top(second, F.max) < top(third, F.min)


def test_split_too_small_or_tied(spark):
    with pytest.raises(ValueError, match="empty"):
        TimeSplit.fit(timed(spark, range(6)))
    with pytest.raises(ValueError, match="leak"):
        TimeSplit.fit(timed(spark, [*range(13), 13, 13, *range(15, 20)]))


def test_short_class_is_filled_up(spark):
    df = timed(spark, range(30), 0).unionByName(timed(spark, range(100, 103), 1).withColumn("trans_num", F.concat("trans_num", F.lit("x"))))
    got = stratified_sample(df, positives=5, negatives=10).groupBy("is_fraud").count().collect()
    assert {r["is_fraud"]: r["count"] for r in got} == {1: 3, 0: 12}


def test_preprocessor_on_unseen_and_missing_values(spark):
    train = sample(
        spark, merchant=list("abcab"), category=list("xyxyx"), gender=list("FMFMF"), job=["j", None, "j", "k", "k"], first="f", last="l", city_pop=5
    )
    model = P.Preprocessor.fit(train)
    assert model.feature_names() == [*P.SCALED, *P.CODED, "category_x", "category_y", "gender_F", "gender_M"]
    new = sample(spark, merchant="zzz", category="q", gender=None, job=None, city_pop=7, first="f", last="l")
    row = model.transform(new).first()
    assert row["merchant"] == -1
    assert (row["category_x"], row["category_y"], row["gender_F"], row["gender_M"]) == (0, 0, 0, 0)
    assert row["job"] == 2  # j, k, unknown
    assert row["city_pop"] == 2.0  # no spread in training: divided by one


def test_many_levels_in_one_column(spark):
    df = spark.createDataFrame([(f"v{i:05d}", i) for i in range(6000)], "c string, i int")
    codes = materialise(P.ordinal_codes(df, ["c"]))
    wide = P.sparse_indicators(df.union(spark.createDataFrame([("new", -1), (None, -2)], df.schema)), codes, ["c"])
    got = {r["i"]: r["c_indicator"] for r in wide.collect()}
    assert got == {**{i: {i: 1.0} for i in range(6000)}, -1: {}, -2: {}}
    assert len(P.indicator_levels(df, ["c"])["c"]) == 6000
    with pytest.raises(ValueError, match="sparse_indicators"):
        P.indicator_levels(df, ["c"], most=5999)


def test_strict_schema(spark):
    df = sample(spark, first="f", last="l")
    assert Q.schema_report(df, strict=True).where("NOT present OR null_count > 0").count() == 0
    with pytest.raises(ValueError, match="amt"):
        Q.schema_report(df.drop("amt"), strict=True)
    with pytest.raises(ValueError, match="nulls"):
        Q.schema_report(df.withColumn("amt", F.lit(None).cast("double")), strict=True)
    report = {r["column"]: r for r in Q.schema_report(df.drop("amt").withColumn("lat", F.lit("x"))).collect()}
    assert (report["amt"]["present"], report["lat"]["type_ok"]) == (False, False)


def test_dedup_keeps_the_first_also_of_null_ids(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), (None, 5, "n5"), (None, 4, "n4"), ("b", 3, "only")]
    df = spark.createDataFrame(rows, "trans_num string, pos int, v string")
    assert {r["v"] for r in Q.dedup_first(df, order="pos").collect()} == {"early", "n4", "only"}
    lost = spark.createDataFrame([("a", None, "x"), ("a", None, "y"), ("b", None, "z"), ("b", 9, "w")], df.schema)
    assert {(r["trans_num"], r["v"] != "z") for r in Q.dedup_first(lost, order="pos").collect()} == {("a", True), ("b", True)}


def test_statistics_of_an_empty_table(spark):
    row = Q.dataset_stats(sample(spark).limit(0)).first()
    assert (row["n_rows"], row["fraud_count"], row["fraud_ratio_pct"]) == (0, 0, 0.0)
