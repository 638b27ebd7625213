"""Fitted state as plain tables: every model is a folder of Parquet tables plus one table of named scalars.

Writes are not transactional across the tables of one model; write each model to a fresh path.
"""

import json

from pyspark.sql import DataFrame, SparkSession

from cardsentry.operators.features import FeatureStore
from cardsentry.operators.preprocess import Preprocessor
from cardsentry.operators.scoring import Ensemble
from cardsentry.operators.transaction import TransactionModel
from cardsentry.session import small_table


def save_scalars(spark: SparkSession, values: dict, path: str) -> None:
    rows = [(k, json.dumps(v)) for k, v in values.items()]
    small_table(spark, rows, "name string, value string").coalesce(1).write.mode("overwrite").parquet(path)


def load_scalars(spark: SparkSession, path: str) -> dict:
    return {r["name"]: json.loads(r["value"]) for r in spark.read.parquet(path).collect()}


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_feature_store(store: FeatureStore, spark: SparkSession, path: str) -> None:
    m = store.transaction
    if m.card_means is not None:
        save_table(m.card_means, f"{path}/card_means")
    if m.category_rates is not None:
        save_table(m.category_rates, f"{path}/category_rates")
    scalars = {
        "global_mean": m.global_mean,
        "global_rate": m.global_rate,
        "high_risk": list(m.high_risk),
        "category": m.category,
        "has_cards": m.card_means is not None,
        "has_categories": m.category_rates is not None,
        "amount_std": store.amount_std,
        "names": store.names,
    }
    save_scalars(spark, scalars, f"{path}/scalars")


def load_feature_store(spark: SparkSession, path: str) -> FeatureStore:
    s = load_scalars(spark, f"{path}/scalars")
    model = TransactionModel(
        card_means=spark.read.parquet(f"{path}/card_means") if s["has_cards"] else None,
        global_mean=s["global_mean"],
        category_rates=spark.read.parquet(f"{path}/category_rates") if s["has_categories"] else None,
        global_rate=s["global_rate"],
        high_risk=tuple(s["high_risk"]),
        category=s["category"],
    )
    return FeatureStore(model, s["amount_std"], s["names"])


def save_preprocessor(model: Preprocessor, spark: SparkSession, path: str) -> None:
    save_table(model.codes, f"{path}/codes")
    scalars = {"medians": model.medians, "levels": model.levels, "scales": model.scales}
    save_scalars(spark, scalars, f"{path}/scalars")


def load_preprocessor(spark: SparkSession, path: str) -> Preprocessor:
    s = load_scalars(spark, f"{path}/scalars")
    scales = {c: tuple(v) for c, v in s["scales"].items()}
    return Preprocessor(s["medians"], spark.read.parquet(f"{path}/codes"), s["levels"], scales)


def save_ensemble(model: Ensemble, spark: SparkSession, path: str) -> None:
    save_scalars(spark, {"weights": model.weights, "threshold": model.threshold, "low": model.low, "high": model.high}, path)


def load_ensemble(spark: SparkSession, path: str) -> Ensemble:
    s = load_scalars(spark, path)
    return Ensemble(tuple(s["weights"]), s["threshold"], s["low"], s["high"])
