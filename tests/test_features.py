from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardsentry.functions import scalar as S
from cardsentry.operators.features import FeatureStore
from cardsentry.operators.transaction import TransactionModel, top_categories
from cardsentry.schema import RAW_NUMERIC, TRANSACTION_FEATURES, TRANSACTION_SCHEMA, VELOCITY_FEATURES

SUNDAY = datetime(2020, 6, 21, 12, 14, 25, tzinfo=timezone.utc)
SAMPLE = {
    "trans_date_trans_time": SUNDAY, "cc_num": 5100000000000017, "merchant": "shop", "category": "personal_care", "amt": 2.86,
    "gender": "M", "city": "Testville", "state": "OR", "lat": 44.25, "long": -120.5, "city_pop": 1200,
    "job": "Baker", "dob": date(1990, 1, 2), "trans_num": "t-0", "merch_lat": 44.75, "merch_long": -121.25, "is_fraud": 0,
}


def sample(spark, **changes):
    """Five rows of one card at one time; a change may be a value or a list of five."""
    rows = []
    for i in range(5):
        row = {**SAMPLE, "trans_num": f"t{i}", "amt": 10.5 + i}
        rows.append({**row, **{k: v[i] if isinstance(v, list) else v for k, v in changes.items()}})
    fields = [f for f in TRANSACTION_SCHEMA.fields if f.name in rows[0]]
    return spark.createDataFrame([tuple(r[f.name] for f in fields) for r in rows], StructType(fields))


def fitted(df):
    return {r["trans_num"]: r for r in TransactionModel.fit(df).transform(df).collect()}


def test_amount_features(spark):
    out = fitted(sample(spark, amt=[50.0, 49.95, 0.0, 2.86, 100.25]))
    assert all(r["log_amount"] >= 0 for r in out.values())
    assert out["t1"]["amount_decimal"] == pytest.approx(0.95)
    assert (out["t0"]["is_round_amount"], out["t1"]["is_round_amount"]) == (1, 0)


def test_negative_amounts_have_positive_decimals(spark):
    value = spark.range(1).select(S.amount_decimal(F.lit(-1.25))).first()[0]
    assert value == 0.75


def test_time_features(spark):
    monday = datetime(2020, 6, 22, 23, 0, tzinfo=timezone.utc)
    out = fitted(sample(spark, trans_date_trans_time=[SUNDAY, monday, SUNDAY, SUNDAY, SUNDAY]))
    assert (out["t0"]["hour_of_day"], out["t0"]["day_of_week"], out["t0"]["is_weekend"], out["t0"]["is_night"]) == (12, 6, 1, 0)
    assert (out["t1"]["hour_of_day"], out["t1"]["day_of_week"], out["t1"]["is_weekend"], out["t1"]["is_night"]) == (23, 0, 0, 1)


def test_distance(spark):
    out = fitted(sample(spark, merch_lat=[44.25, -44.25, None, 44.0, 44.0], merch_long=[-120.5, 59.5, 1.0, -120.0, -121.0]))
    assert out["t0"]["distance_to_merchant"] == pytest.approx(0.0, abs=1e-6)
    assert out["t1"]["distance_to_merchant"] == pytest.approx(3.141592653589793 * 6371.0, rel=1e-6)
    assert out["t2"]["distance_to_merchant"] is None
    assert out["t3"]["distance_to_merchant"] > 0


def test_age_of_the_sample(spark):
    out = fitted(sample(spark))
    days = (SUNDAY.date() - SAMPLE["dob"]).days
    assert out["t0"]["age"] == pytest.approx(days / 365.25, abs=1 / 365.25)
    assert out["t0"]["age_group"] == "31-45"


def test_age_group_edges(spark):
    ages = [16.99, 17.0, 30.0, 30.01, 45.0, 60.0, 60.5, 150.0, 151.0, None]
    df = spark.createDataFrame([(a,) for a in ages], "age double")
    got = df.select(S.age_group(F.col("age")).alias("g"), S.age_group(F.col("age"), False).alias("h")).withColumn(
        "code", S.age_group_code(F.col("g"))
    )
    rows = got.collect()
    assert [r["g"] for r in rows] == [None, "18-30", "18-30", "31-45", "31-45", "46-60", "60+", "60+", None, None]
    assert [r["code"] for r in rows] == [-1, 0, 0, 1, 1, 2, 3, 3, -1, -1]
    assert rows[1]["h"] is None


def test_foreign_state_nulls_are_equal(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B"), (None, None), ("A", None)], "a string, b string")
    assert [r[0] for r in df.select(S.differs(F.col("a"), F.col("b"))).collect()] == [0, 1, 0, 1]


def test_unknown_card_and_zero_mean_use_the_global_mean(spark):
    train = sample(spark, cc_num=[1, 1, 2, 2, 3], amt=[10.0, 30.0, 0.0, 0.0, 60.0])
    new = sample(spark, cc_num=[1, 2, 9, 9, 3], amt=20.0)
    out = {r["trans_num"]: r["amount_to_mean_ratio"] for r in TransactionModel.fit(train).transform(new).collect()}
    assert out == {"t0": 1.0, "t1": 1.0, "t2": 1.0, "t3": 1.0, "t4": pytest.approx(1 / 3)}


def test_unfitted_model_uses_neutral_values(spark):
    row = TransactionModel().transform(sample(spark)).first()
    assert (row["amount_to_mean_ratio"], row["category_fraud_rate"], row["is_high_risk_category"]) == (row["amt"], 0.0, 0)


def test_unseen_category_gets_the_global_rate(spark):
    train = sample(spark, category=list("aabbb"), is_fraud=[1, 0, 0, 0, 0])
    row = TransactionModel.fit(train).transform(sample(spark, category="z")).first()
    assert (row["category_fraud_rate"], row["is_high_risk_category"]) == (pytest.approx(0.2), 0)


def test_top_categories_break_ties_by_name(spark):
    rates = spark.createDataFrame([(c, 0.5) for c in "gfedcba"], "category string, rate double")
    assert [r["category"] for r in top_categories(rates).collect()] == list("abcde")


def test_feature_matrix_has_25_columns_in_order_without_nulls(spark):
    df = sample(spark)
    store = FeatureStore.fit(df)
    expected = RAW_NUMERIC + [c for c in TRANSACTION_FEATURES if c != "is_foreign_state"] + VELOCITY_FEATURES
    assert store.names == expected and len(expected) == 25
    out = store.transform(df)
    assert out.columns == ["trans_num", "is_fraud", *expected]
    rows = {r["trans_num"]: r for r in out.collect()}
    assert all(v is not None for r in rows.values() for v in r)
    # equal times: the card's rows are taken in id order
    assert [rows[f"t{i}"]["txn_count_1h"] for i in range(5)] == [1, 2, 3, 4, 5]
    assert [rows[f"t{i}"]["rapid_fire_flag"] for i in range(5)] == [0, 0, 0, 1, 1]


def test_single_records_have_no_history(spark):
    df = sample(spark)
    for r in FeatureStore.fit(df).transform(df.drop("lat"), velocity="stateless").collect():
        assert (r["time_since_last_txn"], r["txn_count_1h"], r["txn_count_24h"], r["amount_zscore"]) == (0, 1, 1, 0)
        assert r["avg_amount_24h"] == r["amt"]
        assert (r["lat"], r["distance_to_merchant"]) == (0, 0)
