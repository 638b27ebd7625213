"""Per-card velocity features without look-ahead.

A frame holds the card's rows up to and including the current one (rows of equal time are ordered by row id) whose age,
cut to whole seconds, is at most the window length.

Cards of ordinary size use window functions: one shuffle on the card. A card with more than ``HOT_CARD_ROWS`` rows would
make one long task, and its sliding frames cost rows x frame. Such cards are turned into arrivals and expiries along
time and summed by ``running_totals``, which spreads one card over any number of tasks and is linear in its rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.functions.scalar import micros
from cardsentry.operators.ordering import BROADCAST_ROWS, running_totals
from cardsentry.schema import AMOUNT, CARD, ROW_ID, TIME, VELOCITY_FEATURES

# Window lengths in seconds and the two count limits.
TEN_MINUTES, ONE_HOUR, ONE_DAY = 600, 3600, 86400
RAPID_FIRE_ABOVE = 3
MIN_HISTORY = 3
HOT_CARD_ROWS = 20_000


def frame_micros(seconds: int) -> int:
    """Whole-second ages up to ``seconds`` are microsecond ages below ``seconds + 1``."""
    return (seconds + 1) * 1_000_000


def global_amount_std(df: DataFrame) -> float:
    """Sample standard deviation of the amount; 0 and undefined become 1."""
    std = df.agg(F.stddev_samp(F.col(AMOUNT).cast("double")).alias("s")).first()["s"]
    return std if std else 1.0


def _zscore(amt, n_past, mean_past, std_past, global_std: float):
    std = F.when((n_past >= MIN_HISTORY) & (std_past > 0), std_past).otherwise(F.lit(float(global_std)))
    return F.when(n_past > 0, (amt - mean_past) / std).otherwise(F.lit(0.0))


def _ordinary(df: DataFrame, global_std: float, row_id: str) -> DataFrame:
    amt, us = F.col(AMOUNT).cast("double"), F.col("_us")
    in_order = Window.partitionBy(CARD).orderBy("_us", row_id)
    past = in_order.rowsBetween(Window.unboundedPreceding, -1)
    by_time = Window.partitionBy(CARD).orderBy("_us")
    later_peers = Window.partitionBy(CARD, "_us").orderBy(row_id).rowsBetween(1, Window.unboundedFollowing)

    def frame(seconds):
        return by_time.rangeBetween(1 - frame_micros(seconds), 0)

    def count(seconds):
        # position minus first position in the frame: exact although the range frame also holds later peers
        return (F.col("_i") - F.min("_i").over(frame(seconds)) + 1).cast("long")

    indexed = df.withColumns(
        {
            "_i": F.row_number().over(in_order),
            "time_since_last_txn": (us - F.lag("_us").over(in_order)) / F.lit(1e6),
            "_mean": F.avg(amt).over(past),
            "_std": F.stddev_pop(amt).over(past),
            "_later": F.coalesce(F.sum(amt).over(later_peers), F.lit(0.0)),
        }
    )
    counted = indexed.withColumns(
        {
            "rapid_fire_flag": (count(TEN_MINUTES) > RAPID_FIRE_ABOVE).cast("int"),
            "txn_count_1h": count(ONE_HOUR),
            "txn_count_24h": count(ONE_DAY),
            "_sum": F.sum(amt).over(frame(ONE_DAY)) - F.col("_later"),
        }
    )
    return counted.withColumns(
        {
            "avg_amount_24h": F.col("_sum") / F.col("txn_count_24h"),
            "amount_zscore": _zscore(amt, F.col("_i") - 1, F.col("_mean"), F.col("_std"), global_std),
        }
    ).select(*[c for c in df.columns if c != "_us"], *VELOCITY_FEATURES)


def _hot(df: DataFrame, global_std: float, row_id: str) -> DataFrame:
    """``df`` carries the mean amount of each card as ``_centre``: sums run over distances from it, so that the digits of
    a small spread around a large mean are kept."""
    payload = [c for c in df.columns if c not in ("_us", "_centre")]
    us, x = F.col("_us"), F.col(AMOUNT).cast("double") - F.col("_centre")
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")

    def event(t, kind, d10, d1h, d24, a24, **own):
        nothing = {"n": zero, "s": F.lit(0.0), "q": F.lit(0.0), "at": F.lit(None).cast("long"), "x": F.lit(None).cast("double"), "centre": F.lit(None).cast("double")}
        own = {**nothing, **own}
        row = F.when(F.lit(kind == 1), F.struct(*payload))
        return F.struct(
            t.alias("t"), F.lit(kind).alias("kind"), F.col(row_id).alias("id"),
            d10.alias("d10"), d1h.alias("d1h"), d24.alias("d24"), a24.alias("a24"),
            *[v.alias(k) for k, v in own.items()], row.alias("row"),
        )

    # at equal times expiries (kind 0) come before arrivals (kind 1)
    events = df.select(
        F.col(CARD).alias("card"),
        F.explode(
            F.array(
                event(us, 1, one, one, one, x, n=one, s=x, q=x * x, at=us, x=x, centre=F.col("_centre")),
                event(us + frame_micros(TEN_MINUTES), 0, -one, zero, zero, F.lit(0.0)),
                event(us + frame_micros(ONE_HOUR), 0, zero, -one, zero, F.lit(0.0)),
                event(us + frame_micros(ONE_DAY), 0, zero, zero, -one, -x),
            )
        ).alias("e"),
    ).select("card", "e.*")
    summed = running_totals(
        events,
        ["card"],
        [F.col("t"), F.col("kind"), F.col("id")],
        sums={"c10": "d10", "c1h": "d1h", "c24": "d24", "s24": "a24"},
        prior_sums={"n_past": "n", "s_past": "s", "q_past": "q"},
        prior_max={"last_at": "at", "max_x": "x"},
        prior_min={"min_x": "x"},
    ).where("kind = 1")
    mean = F.col("s_past") / F.nullif(F.col("n_past"), F.lit(0).cast("long"))
    variance = F.col("q_past") / F.nullif(F.col("n_past"), F.lit(0).cast("long")) - mean * mean
    # a constant history has no spread, whatever the rounding says
    std = F.when(F.col("max_x") > F.col("min_x"), F.sqrt(F.greatest(variance, F.lit(0.0))))
    return summed.select(
        "row.*",
        ((F.col("t") - F.col("last_at")) / F.lit(1e6)).alias("time_since_last_txn"),
        (F.col("c10") > RAPID_FIRE_ABOVE).cast("int").alias("rapid_fire_flag"),
        F.col("c1h").alias("txn_count_1h"),
        F.col("c24").alias("txn_count_24h"),
        (F.col("s24") / F.col("c24") + F.col("centre")).alias("avg_amount_24h"),
        _zscore(F.col("x"), F.col("n_past"), mean, std, global_std).alias("amount_zscore"),
    )


def velocity_features(
    df: DataFrame, global_std: float = 1.0, *, row_id: str = ROW_ID, hot_card_rows: int = HOT_CARD_ROWS
) -> DataFrame:
    """Add the six velocity features. Rows without card or time have no place in any history; they get the values of a
    record on its own."""
    missing = [c for c in (TIME, CARD, AMOUNT) if c not in df.columns]
    if missing:
        raise ValueError(f"velocity features need the columns {missing}")
    placed = F.col(CARD).isNotNull() & F.col(TIME).isNotNull()
    timed = df.where(placed).withColumn("_us", micros(F.col(TIME)))
    alone = single_row_velocity(df.where(~placed))

    # reads the card and amount columns only, combines before the shuffle
    per_card = timed.groupBy(CARD).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(AMOUNT).cast("double")).alias("_centre"))
    hot = per_card.where(F.col("n") > hot_card_rows).select(CARD, F.coalesce("_centre", F.lit(0.0)).alias("_centre"))
    cards = hot.limit(BROADCAST_ROWS + 1).count()
    if not cards:
        return _ordinary(timed, global_std, row_id).unionByName(alone)
    if cards <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    ordinary = _ordinary(timed.join(hot, CARD, "left_anti"), global_std, row_id)
    # the join brings its key to the front
    spread = timed.join(hot, CARD).select(*timed.columns, "_centre")
    return ordinary.unionByName(_hot(spread, global_std, row_id)).unionByName(alone)


def single_row_values() -> dict[str, Column]:
    """What the features are for a record without any history."""
    return {
        "time_since_last_txn": F.lit(None).cast("double"),
        "rapid_fire_flag": F.lit(0),
        "txn_count_1h": F.lit(1).cast("long"),
        "txn_count_24h": F.lit(1).cast("long"),
        "avg_amount_24h": F.col(AMOUNT).cast("double"),
        "amount_zscore": F.lit(0.0),
    }


def single_row_velocity(df: DataFrame) -> DataFrame:
    """Every record on its own, as in one-record serving."""
    return df.withColumns(single_row_values())
