"""Tables of the test data, and the card-transaction view derived from them."""

from pyspark.sql import DataFrame, SparkSession

from cardsentry.session import prepare

# events become transactions; customer and nation supply names and states. The three score columns are deterministic
# stand-ins so that blending, thresholds, curves, drift and alerts can be checked without trained models.
TRANSACTION_COLUMNS = [
    "cast(e.event_id AS string) trans_num",
    "e.event_id",
    "cast(e.ts AS timestamp) trans_date_trans_time",
    "e.user_id cc_num",
    "concat('merchant_', cast(pmod(e.event_id * 31, 200) AS string)) merchant",
    "e.event_type category",
    "e.value amt",
    "c.c_name first",
    "cast(null AS string) last",
    "CASE WHEN pmod(e.user_id, 2) = 0 THEN 'F' ELSE 'M' END gender",
    "concat('city_', cast(pmod(e.user_id, 60) AS string)) city",
    "n.n_name state",
    "c.c_mktsegment job",
    "25D + pmod(e.user_id * 977, 2500) / 100D lat",
    "-125D + pmod(e.user_id * 1543, 5800) / 100D long",
    "pmod(e.user_id * 7919, 1000000) city_pop",
    "date_add(date'1940-01-01', cast(pmod(e.user_id * 9973, 24000) AS int)) dob",
    "25D + pmod(e.user_id * 977, 2500) / 100D + (pmod(e.event_id * 13, 200) - 100) / 100D merch_lat",
    "-125D + pmod(e.user_id * 1543, 5800) / 100D + (pmod(e.event_id * 29, 200) - 100) / 100D merch_long",
    "concat('NATION_', cast(pmod(e.event_id, 25) AS string)) merch_state",
    "CASE WHEN cast(get_json_object(e.props, '$.k') AS int) = 0 OR e.value > 200 THEN 1 ELSE 0 END is_fraud",
    "least(e.value / 300D, 1D) iso_score",
    "cast(get_json_object(e.props, '$.k') AS int) / 99D ae_score",
    "pmod(e.event_id * 7919, 1000) / 999D xgb_score",
    "5D + pmod(e.event_id * 37, 997) / 100D processing_time_ms",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def as_transactions(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Map events to transactions; ``events`` may be a stream. The join strategy is left to the optimizer's sizes."""
    return (
        events.alias("e")
        .join(customer.alias("c"), events["user_id"] == customer["c_custkey"], "left")
        .join(nation.alias("n"), customer["c_nationkey"] == nation["n_nationkey"], "left")
        .selectExpr(*TRANSACTION_COLUMNS)
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(*(table(spark, sf_dir, t) for t in ("events", "customer", "nation")))
