"""Table layouts and fixed names shared by every operator."""

from pyspark.sql import types as T

TIME = "trans_date_trans_time"
CARD = "cc_num"
AMOUNT = "amt"
LABEL = "is_fraud"
ROW_ID = "trans_num"

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField(TIME, T.TimestampType()),
        T.StructField(CARD, T.LongType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField(AMOUNT, T.DoubleType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("city_pop", T.LongType()),
        T.StructField("job", T.StringType()),
        T.StructField("dob", T.DateType()),
        T.StructField(ROW_ID, T.StringType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField(LABEL, T.IntegerType()),
    ]
)

SCORED_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("fraud_score", T.DoubleType()),
        T.StructField("risk_tier", T.StringType()),
        T.StructField("iso_score", T.DoubleType()),
        T.StructField("ae_score", T.DoubleType()),
        T.StructField("xgb_score", T.DoubleType()),
        T.StructField("should_alert", T.BooleanType()),
        T.StructField("processing_time_ms", T.DoubleType()),
    ]
)

PREDICTION_LOG_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("fraud_score", T.DoubleType()),
        T.StructField("risk_tier", T.StringType()),
        T.StructField("processing_time_ms", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
    ]
)

# Column groups whose names and order define the tables that users exchange.
REQUIRED_COLUMNS = TRANSACTION_SCHEMA.fieldNames()
NON_NULL_COLUMNS = [TIME, CARD, AMOUNT, LABEL]
EXPECTED_NUMERIC = ["amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "is_fraud"]
STREAM_REQUIRED = [TIME, CARD, AMOUNT]
RAW_NUMERIC = ["amt", "lat", "long", "city_pop", "merch_lat", "merch_long"]
TRANSACTION_FEATURES = [
    "log_amount",
    "amount_decimal",
    "is_round_amount",
    "amount_to_mean_ratio",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_night",
    "distance_to_merchant",
    "category_fraud_rate",
    "is_high_risk_category",
    "age",
    "age_group",
    "is_foreign_state",
]
VELOCITY_FEATURES = [
    "time_since_last_txn",
    "rapid_fire_flag",
    "txn_count_1h",
    "txn_count_24h",
    "avg_amount_24h",
    "amount_zscore",
]
