"""The feature store: fit on one table, transform any table or stream into one fixed, typed feature matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.functions import scalar as S
from cardsentry.operators.transaction import TOP_CATEGORIES, TransactionModel
from cardsentry.operators.velocity import global_amount_std, single_row_velocity, velocity_features
from cardsentry.schema import LABEL, RAW_NUMERIC, ROW_ID, TRANSACTION_FEATURES, VELOCITY_FEATURES


def feature_names(columns: list[str]) -> list[str]:
    """The features present among ``columns``, in their fixed order."""
    return [c for c in RAW_NUMERIC + TRANSACTION_FEATURES + VELOCITY_FEATURES if c in columns]


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast to double; null and NaN become 0."""
    return df.withColumns(
        {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in columns}
    )


@dataclass
class FeatureStore:
    transaction: TransactionModel
    amount_std: float
    names: list[str]

    @staticmethod
    def fit(train: DataFrame, category: str = "category", k: int = TOP_CATEGORIES) -> FeatureStore:
        model = TransactionModel.fit(train, category, k)
        columns = [*train.columns, *model.added_columns(train), *VELOCITY_FEATURES]
        return FeatureStore(model, global_amount_std(train), feature_names(columns))

    def engineer(self, df: DataFrame, velocity: str = "stateful", row_id: str = ROW_ID) -> DataFrame:
        """All original columns plus all features, nulls kept. ``velocity`` is 'stateful', 'stateless' or 'present'."""
        if velocity == "stateful":
            df = velocity_features(df, self.amount_std, row_id=row_id)
        elif velocity == "stateless":
            df = single_row_velocity(df)
        return self.transaction.transform(df)

    def transform(
        self, df: DataFrame, velocity: str = "stateful", keep: tuple[str, ...] = (ROW_ID, LABEL), row_id: str = ROW_ID
    ) -> DataFrame:
        """The feature matrix: kept key and label columns, then the features as doubles in fixed order."""
        wide = self.engineer(df, velocity, row_id)
        if "age_group" in wide.columns:
            wide = wide.withColumn("age_group", S.age_group_code(F.col("age_group")))
        absent = {c: F.lit(0.0) for c in self.names if c not in wide.columns}
        wide = fill_zero(wide.withColumns(absent) if absent else wide, self.names)
        return wide.select(*[c for c in keep if c in wide.columns], *self.names)
