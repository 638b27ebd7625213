"""Amount, time, place, category and person features of single transactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.functions import scalar as S
from cardsentry.operators.ordering import lookup
from cardsentry.schema import AMOUNT, CARD, LABEL, TIME
from cardsentry.session import materialise

TOP_CATEGORIES = 5


def is_positive(label: str = LABEL):
    return (F.col(label).cast("int") == 1).cast("int")


def card_mean_amount(df: DataFrame) -> DataFrame:
    """Mean amount and row count per card."""
    return (
        df.where(F.col(CARD).isNotNull())
        .groupBy(CARD)
        .agg(F.avg(AMOUNT).alias("card_mean"), F.count(F.lit(1)).alias("n"))
    )


def category_rate(df: DataFrame, category: str = "category") -> DataFrame:
    """Rows, positives and positive rate per category."""
    return (
        df.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.count(LABEL).alias("total"), F.sum(is_positive()).alias("fraud"))
        .withColumn("rate", S.ratio_or_zero(F.col("fraud"), F.col("total")))
    )


def top_categories(rates: DataFrame, category: str = "category", k: int = TOP_CATEGORIES) -> DataFrame:
    """The k categories of highest rate; equal rates in category order."""
    return rates.orderBy(F.desc("rate"), F.asc(category)).limit(k)


def stateless_columns(df: DataFrame) -> dict:
    """Features that need no fitted state; each group appears only when its inputs exist."""
    have = set(df.columns)
    out = {}
    if AMOUNT in have:
        out["log_amount"] = S.log_amount(F.col(AMOUNT))
        out["amount_decimal"] = S.amount_decimal(F.col(AMOUNT))
        out["is_round_amount"] = S.is_round_amount(F.col(AMOUNT))
    if TIME in have:
        ts = F.col(TIME)
        out["hour_of_day"] = S.hour_of_day(ts)
        out["day_of_week"] = S.day_of_week(ts)
        out["is_weekend"] = S.is_weekend(ts)
        out["is_night"] = S.is_night(ts)
    if {"lat", "long", "merch_lat", "merch_long"} <= have:
        out["distance_to_merchant"] = S.haversine_km(*map(F.col, ["lat", "long", "merch_lat", "merch_long"]))
    if {"state", "merch_state"} <= have:
        out["is_foreign_state"] = S.differs(F.col("state"), F.col("merch_state"))
    if {"dob", TIME} <= have:
        out["age"] = S.age_years(F.col(TIME), F.col("dob"))
        out["age_group"] = S.age_group(out["age"])
    return out


@dataclass
class TransactionModel:
    """Fitted state: two lookup tables, two scalars and the high-risk categories."""

    card_means: DataFrame | None = None
    global_mean: float = 1.0
    category_rates: DataFrame | None = None
    global_rate: float = 0.0
    high_risk: tuple[str, ...] = ()
    category: str = "category"

    @staticmethod
    def fit(df: DataFrame, category: str = "category", k: int = TOP_CATEGORIES) -> TransactionModel:
        model = TransactionModel(category=category)
        have = set(df.columns)
        totals = df.agg(
            *([F.avg(AMOUNT).alias("mean")] if AMOUNT in have else [F.lit(None).alias("mean")]),
            *([F.avg(is_positive()).alias("rate")] if LABEL in have else [F.lit(None).alias("rate")]),
        ).first()
        if {AMOUNT, CARD} <= have:
            model.card_means = materialise(card_mean_amount(df))
            model.global_mean = totals["mean"] or 1.0
        if {category, LABEL} <= have:
            model.category_rates = materialise(category_rate(df, category))
            model.global_rate = totals["rate"] or 0.0
            model.high_risk = tuple(r[0] for r in top_categories(model.category_rates, category, k).collect())
        return model

    def added_columns(self, df: DataFrame) -> list[str]:
        """The features ``transform`` adds to a table with the columns of ``df``."""
        by_state = {"amount_to_mean_ratio": AMOUNT, "category_fraud_rate": self.category, "is_high_risk_category": self.category}
        return [*stateless_columns(df), *[f for f, c in by_state.items() if c in df.columns]]

    def transform(self, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        out = df
        if AMOUNT in have:
            mean = F.lit(float(self.global_mean))
            if self.card_means is not None and CARD in have:
                out = lookup(out, self.card_means, CARD, "card_mean", "n")
                # an unknown card and a card of mean 0 both use the global mean
                mean = F.coalesce(F.nullif(F.col("card_mean"), F.lit(0.0)), mean)
            out = out.withColumn("amount_to_mean_ratio", F.col(AMOUNT).cast("double") / mean).drop("card_mean")
        if self.category in have:
            rate, risky = F.lit(float(self.global_rate)), F.lit(0)
            if self.category_rates is not None:
                out = lookup(out, self.category_rates, self.category, "rate", "total")
                rate = F.coalesce(F.col("rate"), rate)
                risky = F.coalesce(F.col(self.category).isin(list(self.high_risk)).cast("int"), F.lit(0))
            out = out.withColumns({"category_fraud_rate": rate, "is_high_risk_category": risky}).drop("rate")
        return out.withColumns(stateless_columns(df))
