"""Chronological train / validation / test split and stratified sampling."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.functions.scalar import micros, stable_hash
from cardsentry.operators.ordering import extremes, values_at_ranks
from cardsentry.operators.quality import require_columns
from cardsentry.operators.transaction import is_positive
from cardsentry.schema import LABEL, ROW_ID, TIME

TRAIN_SHARE, VALIDATION_SHARE = 0.70, 0.15


@dataclass
class TimeSplit:
    """Two timestamps (microseconds): the last one of train and the last one of validation."""

    train_end: int
    val_end: int

    @staticmethod
    def fit(df: DataFrame, train: float = TRAIN_SHARE, val: float = VALIDATION_SHARE) -> "TimeSplit":
        require_columns(df, [TIME, LABEL])
        us = df.select(micros(F.col(TIME)).alias("us"))
        ends = extremes(us, ["us"])
        n = ends["us"][2]
        n_train, n_val = int(n * train), int(n * val)
        if n_train == 0 or n_val == 0:
            raise ValueError(f"{n} rows leave an empty train or validation part")
        cut = n_train + n_val
        # whole numbers below 2**53 are exact as doubles
        at = values_at_ranks(us, {"us": [r for r in (n_train - 1, n_train, cut - 1, cut) if r < n]}, ends)["us"]
        if at[n_train - 1] >= at[n_train] or (cut < n and at[cut - 1] >= at[cut]):
            raise ValueError("rows of equal time on both sides of a boundary would leak between the parts")
        return TimeSplit(int(at[n_train - 1]), int(at[cut - 1]))

    def label(self, df: DataFrame) -> DataFrame:
        us = micros(F.col(TIME))
        part = F.when(us <= self.train_end, "train").when(us <= self.val_end, "val").otherwise("test")
        return df.withColumn("split", part)

    def parts(self, df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Three filters on the time column; they reach a Parquet scan as pushed filters."""
        first, second = (F.timestamp_micros(F.lit(b)) for b in (self.train_end, self.val_end))
        ts = F.col(TIME)
        return df.where(ts <= first), df.where((ts > first) & (ts <= second)), df.where(ts > second)


def time_split(df: DataFrame, train: float = TRAIN_SHARE, val: float = VALIDATION_SHARE) -> DataFrame:
    return TimeSplit.fit(df, train, val).label(df)


def split_summary(labelled: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return labelled.groupBy("split").agg(
        n.alias("n"),
        F.min(micros(F.col(TIME))).alias("min_us"),
        F.max(micros(F.col(TIME))).alias("max_us"),
        (100.0 * F.sum(is_positive()) / n).alias("fraud_rate_pct"),
    )


def sort_by_time(df: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    return df.orderBy(TIME, row_id)


def stratified_sample(
    df: DataFrame, positives: int = 136, negatives: int = 7864, *, row_id: str = ROW_ID
) -> DataFrame:
    """Exactly ``positives + negatives`` rows (fewer only if the table is smaller); a short class is filled up from the
    other. Rows are taken in the order of a hash of their id, so the sample is repeatable."""
    have = df.agg(F.count_if(is_positive() == 1).alias("pos"), F.count_if(is_positive() == 0).alias("neg")).first()
    total = positives + negatives
    take_pos, take_neg = min(positives, have["pos"]), min(negatives, have["neg"])
    take_neg = min(have["neg"], total - take_pos)
    take_pos = min(have["pos"], total - take_neg)

    def pick(flag, k):
        return df.where(is_positive() == flag).orderBy(stable_hash(F.col(row_id)), row_id).limit(k)

    return sort_by_time(pick(1, take_pos).unionByName(pick(0, take_neg)), row_id)
