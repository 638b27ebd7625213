"""Queries: transaction features, velocity features, lookups, the feature store."""

from pyspark.sql import functions as F

from cardsentry.functions import scalar as S
from cardsentry.operators import transaction as TF
from cardsentry.operators.features import FeatureStore, feature_names
from cardsentry.operators.ordering import lookup
from cardsentry.operators.split import TimeSplit
from cardsentry.operators.velocity import global_amount_std, velocity_features
from cardsentry.plans.catalog import PARTS, query, r6, s6, with_txn
from cardsentry.schema import LABEL, TRANSACTION_FEATURES, VELOCITY_FEATURES
from cardsentry.sources.tables import transactions

AGE = "(date_diff('day', dob, trans_date_trans_time::DATE) / 365.25::DOUBLE)"
AGE_GROUP = f"""CASE WHEN {AGE} >= 17 AND {AGE} <= 30 THEN '18-30' WHEN {AGE} > 30 AND {AGE} <= 45 THEN '31-45'
 WHEN {AGE} > 45 AND {AGE} <= 60 THEN '46-60' WHEN {AGE} > 60 AND {AGE} <= 150 THEN '60+' END"""
AGE_CODE = f"""CASE {AGE_GROUP} WHEN '18-30' THEN 0 WHEN '31-45' THEN 1 WHEN '46-60' THEN 2 WHEN '60+' THEN 3 ELSE -1 END"""
DISTANCE = """2 * 6371.0::DOUBLE * asin(sqrt(least(1::DOUBLE, pow(sin((radians(merch_lat) - radians(lat)) / 2), 2)
 + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin((radians(merch_long) - radians(long)) / 2), 2))))"""
# name -> (SQL expression, is a real number)
PLAIN_FEATURES = {
    "log_amount": ("ln(1 + amt)", True),
    "amount_decimal": ("amt - floor(amt)", True),
    "is_round_amount": ("(amt = round(amt))::INT", False),
    "hour_of_day": ("hour(trans_date_trans_time)::INT", False),
    "day_of_week": ("(isodow(trans_date_trans_time) - 1)::INT", False),
    "is_weekend": ("(isodow(trans_date_trans_time) >= 6)::INT", False),
    "is_night": ("(hour(trans_date_trans_time) >= 22 OR hour(trans_date_trans_time) < 6)::INT", False),
    "distance_to_merchant": (DISTANCE, True),
    "is_foreign_state": ("(state IS DISTINCT FROM merch_state)::INT", False),
    "age": (AGE, True),
    "age_group": (AGE_GROUP, False),
}


def _register_plain(name: str, expression: str, real: bool) -> None:
    @query(name, with_txn(f"SELECT trans_num, {s6(expression) if real else expression} AS {name} FROM txn"))
    def _(spark, sf_dir):
        df = transactions(spark, sf_dir)
        value = TF.stateless_columns(df)[name]
        return df.select("trans_num", (r6(value) if real else value).alias(name))


for _name, (_sql, _real) in PLAIN_FEATURES.items():
    _register_plain(_name, _sql, _real)


@query("age_group_code", with_txn(f"SELECT trans_num, {AGE_CODE} AS age_group_code FROM txn"))
def _age_group_code(spark, sf_dir):
    df = transactions(spark, sf_dir)
    group = TF.stateless_columns(df)["age_group"]
    return df.select("trans_num", S.age_group_code(group).alias("age_group_code"))


CARD_MEANS = "means AS (SELECT cc_num, avg(amt) card_mean FROM txn GROUP BY cc_num), overall AS (SELECT avg(amt) m, avg(is_fraud) r FROM txn)"
RATIO = "amt / coalesce(nullif(card_mean, 0), m)"


def _rates(category: str, k: int = 5, source: str = "txn") -> str:
    return f"""rates AS (SELECT {category} cat, sum(is_fraud) / count(is_fraud)::DOUBLE rate FROM {source} GROUP BY {category}),
 top AS (SELECT cat FROM rates ORDER BY rate DESC, cat LIMIT {k})"""


@query(
    "amount_to_mean_ratio",
    with_txn(
        f"SELECT trans_num, {s6(RATIO)} AS amount_to_mean_ratio FROM txn LEFT JOIN means USING (cc_num), overall", CARD_MEANS
    ),
)
def _amount_to_mean_ratio(spark, sf_dir):
    df = transactions(spark, sf_dir).select("trans_num", "cc_num", "amt")
    return TF.TransactionModel.fit(df).transform(df).select("trans_num", r6("amount_to_mean_ratio").alias("amount_to_mean_ratio"))


@query(
    "category_fraud_rate",
    with_txn(f"SELECT trans_num, {s6('rate')} AS category_fraud_rate FROM txn JOIN rates ON category = cat", _rates("category")),
)
def _category_fraud_rate(spark, sf_dir):
    df = transactions(spark, sf_dir).select("trans_num", "category", LABEL)
    return TF.TransactionModel.fit(df).transform(df).select("trans_num", r6("category_fraud_rate").alias("category_fraud_rate"))


# merchants stand in for categories: the test data has only five of those, so every one would be among the top five
@query(
    "is_high_risk_category",
    with_txn(
        "SELECT trans_num, (merchant IN (SELECT cat FROM top))::INT AS is_high_risk_category FROM txn", _rates("merchant")
    ),
)
def _is_high_risk_category(spark, sf_dir):
    df = transactions(spark, sf_dir).select("trans_num", "merchant", LABEL)
    return TF.TransactionModel.fit(df, "merchant").transform(df).select("trans_num", "is_high_risk_category")


def _transaction_sql() -> str:
    plain = ", ".join(f"{s6(x) if real else x} AS {n}" for n, (x, real) in PLAIN_FEATURES.items())
    return with_txn(
        f"""SELECT trans_num, {plain}, {s6(RATIO)} AS amount_to_mean_ratio, {s6("rate")} AS category_fraud_rate,
 (merchant IN (SELECT cat FROM top))::INT AS is_high_risk_category
 FROM txn LEFT JOIN means USING (cc_num) LEFT JOIN rates ON merchant = cat, overall""",
        CARD_MEANS,
        _rates("merchant"),
    )


@query("transaction_features", _transaction_sql())
def _transaction_features(spark, sf_dir):
    df = transactions(spark, sf_dir)
    out = TF.TransactionModel.fit(df, "merchant").transform(df)
    real = {n for n, (_, r) in PLAIN_FEATURES.items() if r} | {"amount_to_mean_ratio", "category_fraud_rate"}
    return out.select("trans_num", *[(r6(c) if c in real else F.col(c)).alias(c) for c in TRANSACTION_FEATURES])


def _velocity_ctes(source: str, std: str) -> str:
    """Window features of ``source``; ``std`` is a scalar subquery for the global deviation."""

    def frame(seconds: int) -> str:
        return f"(PARTITION BY cc_num ORDER BY us RANGE BETWEEN {(seconds + 1) * 10**6 - 1} PRECEDING AND CURRENT ROW)"

    return f"""timed AS (SELECT *, epoch_us(trans_date_trans_time) us FROM {source}),
framed AS (SELECT *, (us - lag(us) OVER o) / 1e6::DOUBLE AS time_since_last_txn,
 (count(*) OVER {frame(600)} > 3)::INT AS rapid_fire_flag,
 count(*) OVER {frame(3600)} AS txn_count_1h,
 count(*) OVER {frame(86400)} AS txn_count_24h,
 avg(amt) OVER {frame(86400)} AS avg_amount_24h,
 count(*) OVER p pc, stddev_pop(amt) OVER p ps, avg(amt) OVER p pm, {std} AS gs
 FROM timed WINDOW o AS (PARTITION BY cc_num ORDER BY us, event_id),
 p AS (PARTITION BY cc_num ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
velocity AS (SELECT *, (amt - coalesce(pm, amt)) / CASE WHEN pc >= 3 AND ps > 0 THEN ps ELSE gs END AS amount_zscore FROM framed)"""


ALL_STD = "(SELECT coalesce(nullif(stddev_samp(amt), 0), 1) FROM txn)"
REAL_VELOCITY = {"time_since_last_txn", "avg_amount_24h", "amount_zscore"}


def _velocity_select(columns: list[str]) -> str:
    return ", ".join(f"{s6(c) if c in REAL_VELOCITY else c} AS {c}" for c in columns)


def velocity_sql(columns: list[str]) -> str:
    return with_txn(f"SELECT trans_num, {_velocity_select(columns)} FROM velocity", _velocity_ctes("txn", ALL_STD))


def velocity_columns(df, columns: list[str]):
    return df.select("trans_num", *[(r6(c) if c in REAL_VELOCITY else F.col(c)).alias(c) for c in columns])


def _register_velocity(name: str, columns: list[str], hot_card_rows: int | None = None) -> None:
    @query(name, velocity_sql(columns))
    def _(spark, sf_dir):
        df = transactions(spark, sf_dir).select("trans_num", "cc_num", "trans_date_trans_time", "amt")
        limits = {} if hot_card_rows is None else {"hot_card_rows": hot_card_rows}
        return velocity_columns(velocity_features(df, global_amount_std(df), **limits), columns)


for _name in VELOCITY_FEATURES:
    _register_velocity(_name, [_name])
_register_velocity("velocity_features", VELOCITY_FEATURES)
# the same rows with the cards above 65 rows on the path for hot cards
_register_velocity("velocity_features_hot_cards", VELOCITY_FEATURES, hot_card_rows=65)


@query("global_amount_std", with_txn(f"SELECT {s6(ALL_STD)} AS global_amount_std"))
def _global_amount_std(spark, sf_dir):
    std = F.stddev_samp("amt")
    guarded = F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(1.0))
    return transactions(spark, sf_dir).agg(r6(guarded).alias("global_amount_std"))


def _store_select() -> str:
    cells = {"amt": "amt", "lat": "lat", "long": "long", "city_pop": "city_pop", "merch_lat": "merch_lat", "merch_long": "merch_long"}
    cells |= {n: x for n, (x, _) in PLAIN_FEATURES.items()}
    cells |= {"age_group": AGE_CODE, "amount_to_mean_ratio": RATIO, "category_fraud_rate": "coalesce(rate, r)"}
    cells |= {"is_high_risk_category": "(merchant IN (SELECT cat FROM top))::INT"}
    cells |= {c: c for c in VELOCITY_FEATURES}
    return ", ".join(f"{s6(f'coalesce({x}, 0)')} AS {n}" for n, x in cells.items())


@query(
    "feature_store",
    with_txn(
        f"""SELECT trans_num, is_fraud, {_store_select()} FROM velocity LEFT JOIN means USING (cc_num)
 LEFT JOIN rates ON merchant = cat, overall""",
        PARTS,
        "train AS (SELECT * FROM parts WHERE split = 'train')",
        CARD_MEANS.replace("FROM txn", "FROM train"),
        _rates("merchant", source="train"),
        _velocity_ctes("txn", ALL_STD.replace("FROM txn", "FROM train")),
    ),
)
def _feature_store(spark, sf_dir):
    """Fitted on the first 70 % of the rows, applied to all of them."""
    df = transactions(spark, sf_dir)
    train, _, _ = TimeSplit.fit(df).parts(df)
    store = FeatureStore.fit(train, "merchant")
    return store.transform(df).select("trans_num", LABEL, *[r6(c).alias(c) for c in store.names])


@query(
    "project_features",
    with_txn("SELECT amt, lat, long, city_pop, merch_lat, merch_long, is_fraud FROM txn"),
)
def _project_features(spark, sf_dir):
    df = transactions(spark, sf_dir)
    return df.select(*feature_names(df.columns), LABEL)


@query(
    "feature_vector_single",
    with_txn(
        f"SELECT trans_num, {s6('time_since')} AS time_since_last_txn, 1::DOUBLE AS txn_count_1h, {s6('amt')} AS avg_amount_24h, "
        f"0::DOUBLE AS amount_zscore, {s6('ln(1 + amt)')} AS log_amount, 0::DOUBLE AS distance_to_merchant FROM (SELECT *, 0 time_since FROM txn)"
    ),
)
def _feature_vector_single(spark, sf_dir):
    """Every record scored on its own, without history; inputs a record lacks (here the coordinates) give 0."""
    df = transactions(spark, sf_dir)
    store = FeatureStore.fit(df)
    lean = df.drop("lat", "long", "merch_lat", "merch_long")
    out = store.transform(lean, velocity="stateless")
    shown = ["time_since_last_txn", "txn_count_1h", "avg_amount_24h", "amount_zscore", "log_amount", "distance_to_merchant"]
    return out.select("trans_num", *[r6(c).alias(c) for c in shown])


@query(
    "lookup_card_mean",
    with_txn(f"SELECT trans_num, {s6('coalesce(card_mean, m)')} AS card_mean FROM txn LEFT JOIN means USING (cc_num), overall", CARD_MEANS),
)
def _lookup_card_mean(spark, sf_dir):
    df = transactions(spark, sf_dir).select("trans_num", "cc_num", "amt")
    model = TF.TransactionModel.fit(df)
    found = lookup(df, model.card_means, "cc_num", "card_mean", "n")
    return found.select("trans_num", r6(F.coalesce("card_mean", F.lit(model.global_mean))).alias("card_mean"))


@query(
    "lookup_category_rate",
    with_txn(f"SELECT trans_num, {s6('coalesce(rate, r)')} AS rate FROM txn LEFT JOIN rates ON merchant = cat, overall", CARD_MEANS, _rates("merchant")),
)
def _lookup_category_rate(spark, sf_dir):
    df = transactions(spark, sf_dir).select("trans_num", "merchant", LABEL)
    model = TF.TransactionModel.fit(df, "merchant")
    found = lookup(df, model.category_rates, "merchant", "rate", "total")
    return found.select("trans_num", r6(F.coalesce("rate", F.lit(model.global_rate))).alias("rate"))


@query(
    "in_set",
    with_txn("SELECT trans_num, merchant FROM txn WHERE merchant IN (SELECT cat FROM top)", _rates("merchant")),
)
def _in_set(spark, sf_dir):
    df = transactions(spark, sf_dir).select("trans_num", "merchant", LABEL)
    top = TF.top_categories(TF.category_rate(df, "merchant"), "merchant")
    # at most five rows by construction
    return df.join(F.broadcast(top), "merchant", "left_semi").select("trans_num", "merchant")


@query("in_list", with_txn("SELECT trans_num, (category IN ('click', 'error'))::INT AS listed FROM txn"))
def _in_list(spark, sf_dir):
    df = transactions(spark, sf_dir)
    return df.select("trans_num", F.col("category").isin("click", "error").cast("int").alias("listed"))


@query("card_mean_amount", with_txn(f"SELECT cc_num, {s6('avg(amt)')} AS card_mean, count(*) AS n FROM txn GROUP BY cc_num"))
def _card_mean_amount(spark, sf_dir):
    means = TF.card_mean_amount(transactions(spark, sf_dir))
    return means.select("cc_num", r6("card_mean").alias("card_mean"), "n")


@query(
    "category_rate",
    with_txn(f"SELECT category, count(*) AS total, sum(is_fraud)::BIGINT AS fraud, {s6('avg(is_fraud)')} AS rate FROM txn GROUP BY category"),
)
def _category_rate(spark, sf_dir):
    rates = TF.category_rate(transactions(spark, sf_dir))
    return rates.select("category", "total", "fraud", r6("rate").alias("rate"))


@query("top_k", with_txn(f"SELECT cat AS merchant, {s6('rate')} AS rate FROM rates ORDER BY rates.rate DESC, cat LIMIT 5", _rates("merchant")))
def _top_k(spark, sf_dir):
    rates = TF.category_rate(transactions(spark, sf_dir), "merchant")
    return TF.top_categories(rates, "merchant").select("merchant", r6("rate").alias("rate"))


@query(
    "state_save",
    with_txn(f"SELECT cc_num, {s6('card_mean')} AS card_mean FROM means", CARD_MEANS),
)
def _state_save(spark, sf_dir):
    """Fit, save, load: the loaded state is what was fitted."""
    from cardsentry.sources.state import load_feature_store, save_feature_store
    from cardsentry.session import scratch_path

    path = scratch_path(spark, "store")
    save_feature_store(FeatureStore.fit(transactions(spark, sf_dir)), spark, path)
    return load_feature_store(spark, path).transaction.card_means.select("cc_num", r6("card_mean").alias("card_mean"))
