"""Order-dependent building blocks that never funnel a table or a hot group through one task.

* ``running_totals``  prefix sums over a total order: rows are range-partitioned on the order itself, so one group may
  span as many tasks as it needs. Per-chunk totals (one row per chunk and group) carry the sums from chunk to chunk.
* ``values_at_ranks``  exact order statistics of numeric columns by repeatedly zooming into a bounded histogram. No sort;
  each pass ships at most about ``LISTED_ROWS`` rows.
* ``lookup``  left equi-lookup into a state table: broadcast only after its rows were counted, otherwise a join in which
  the heaviest keys are served from a bounded broadcast and their rows are spread over all tasks.
"""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.session import materialise

BUCKETS = 1024
LISTED_ROWS = 60_000
BROADCAST_ROWS = 200_000
HEAVY_KEYS = 10_000


def running_totals(
    df: DataFrame,
    by: list[str],
    order: list[Column],
    *,
    sums: dict[str, str] | None = None,
    prior_sums: dict[str, str] | None = None,
    prior_max: dict[str, str] | None = None,
    prior_min: dict[str, str] | None = None,
    group_sums: dict[str, str] | None = None,
) -> DataFrame:
    """Add running aggregates per ``by`` group along ``order`` (which must be total within a group).

    ``sums`` include the current row, the ``prior_*`` aggregates see strictly earlier rows only, and ``group_sums`` are
    those of the whole group (a join back on the group alone would gather a large group in one task).
    """
    # (output, input, aggregate, frame includes the current row, carry-in combiner)
    specs = [(o, c, F.sum, 0) for o, c in (sums or {}).items()]
    specs += [(o, c, F.sum, -1) for o, c in (prior_sums or {}).items()]
    specs += [(o, c, F.max, -1) for o, c in (prior_max or {}).items()]
    specs += [(o, c, F.min, -1) for o, c in (prior_min or {}).items()]

    # The chunk number is taken from the physical partition, so it is frozen in a checkpoint before it is used twice.
    ranged = df.repartitionByRange(*[F.col(c) for c in by], *order)
    frozen = materialise(ranged.withColumn("_chunk", F.spark_partition_id()))

    keys = [*by, "_chunk"]
    whole = group_sums or {}
    chunk_totals = frozen.groupBy(*keys).agg(
        *[agg(c).alias(f"_t_{o}") for o, c, agg, _ in specs], *[F.sum(c).alias(f"_t_{o}") for o, c in whole.items()]
    )
    earlier_chunks = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunk_totals.select(
        *keys,
        *[agg(f"_t_{o}").over(earlier_chunks).alias(f"_c_{o}") for o, _, agg, _ in specs],
        *[F.sum(f"_t_{o}").over(Window.partitionBy(*by)).alias(o) for o in whole],
    )

    in_chunk = Window.partitionBy(*keys).orderBy(*order)
    combine = {F.max: F.greatest, F.min: F.least}
    totals = []
    for o, c, agg, last in specs:
        local = agg(c).over(in_chunk.rowsBetween(Window.unboundedPreceding, last))
        if agg is F.sum:
            total = F.coalesce(local, F.lit(0)) + F.coalesce(F.col(f"_c_{o}"), F.lit(0))
        else:
            total = combine[agg](local, F.col(f"_c_{o}"))  # greatest/least skip nulls
        totals.append(total.alias(o))
    return frozen.join(carry, keys).select(*df.columns, *totals, *whole)


def _number(column: str) -> Column:
    """As a double; NaN is unknown, and there is one zero."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double")) + F.lit(0.0)


def slots(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    """(i, x, slot) for every known value x of the columns: the column's number, and how many of its (ascending) bounds
    are at or below x. A binary search per value, so many bounds cost neither time nor generated code."""
    wide = df.select(*[_number(c).alias(f"x{i}") for i, c in enumerate(bounds)])
    # all values are at or above -inf, and only inf is at inf; the search is among the finite bounds
    finite = {i: [v for v in b if not math.isinf(v)] for i, b in enumerate(bounds.values())}
    inner = [i for i, b in finite.items() if b]
    if inner:
        splits = [[-math.inf, *finite[i], math.inf] for i in inner]
        names = ([f"x{i}" for i in inner], [f"slot{i}" for i in inner])
        wide = Bucketizer(inputCols=names[0], outputCols=names[1], splitsArray=splits, handleInvalid="keep").transform(wide)

    def slot(i: int, own: list[float]) -> Column:
        found = F.col(f"slot{i}").cast("int") if i in inner else F.lit(0)
        at_end = F.when(F.col(f"x{i}") == math.inf, F.lit(sum(v == math.inf for v in own))).otherwise(F.lit(0))
        return (found + F.lit(sum(v == -math.inf for v in own)) + at_end).cast("int")

    cells = [
        F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("x"), slot(i, b).alias("slot"))
        for i, b in enumerate(bounds.values())
    ]
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*").where("x IS NOT NULL")


def extremes(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float, int]]:
    """(lowest, highest, number of values) per column, from one aggregate."""
    stats = {"lo": F.min, "hi": F.max, "n": F.count}
    row = df.agg(*[f(_number(c)).alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in stats.items()]).first()
    return {c: (row[f"lo_{i}"], row[f"hi_{i}"], row[f"n_{i}"]) for i, c in enumerate(columns)}


def values_at_ranks(
    df: DataFrame, ranks: dict[str, list[int]], ends: dict[str, tuple[float, float, int]] | None = None
) -> dict[str, dict[int, float]]:
    """Exact 0-based order statistics of the non-null values of numeric columns: ``{column: {rank: value}}``.

    Each pass over the table looks at the interval of every rank still searched. While the intervals hold many rows they
    are cut into buckets; once they hold few, their values are listed. Either way a pass returns a bounded table.

    The first pass cuts by sign and power of two, which puts infinities, zero and numbers of any size apart; after it an
    interval spans a factor of two at most. Every later one cuts an interval into equal parts, and goes on between the
    smallest and the largest value that are there. So few passes are enough whatever the values are: ten bits each.
    """
    wanted = {c: sorted(set(r)) for c, r in ranks.items() if r}
    ends = ends or (extremes(df, list(wanted)) if wanted else {})
    found: dict[str, dict[int, float]] = {c: {} for c in wanted}
    # searched ranks: (column, rank) -> (lowest value, highest value, rows inside, rows below)
    search = {(c, r): (*ends[c], 0) for c in wanted for r in wanted[c]}
    for (c, r), (_, _, n, _) in search.items():
        if not 0 <= r < n:
            raise ValueError(f"rank {r} is outside column {c}, which has {n} values")
    while True:
        for (c, r), (lo, hi, _, _) in list(search.items()):
            if lo == hi:
                found[c][r] = lo
                del search[c, r]
        if not search:
            return found
        spans = sorted({(c, lo, hi, n) for (c, _), (lo, hi, n, _) in search.items()})
        few = sum(n for *_, n in spans) <= LISTED_ROWS
        buckets = max(32, min(BUCKETS, LISTED_ROWS // len(spans)))
        # the spans of one column are disjoint: a value can only be in the last one that starts at or below it
        starts: dict[str, list[float]] = {}
        for c, lo, _, _ in spans:
            starts.setdefault(c, []).append(lo)
        first = [next(i for i, s in enumerate(spans) if s[0] == c) for c in starts]
        lows, highs = [s[1] for s in spans], [s[2] for s in spans]
        # within a factor of two no difference overflows; wider intervals are cut by powers of two
        wide = [not 0 < max(abs(lo), abs(hi)) <= 2 * min(abs(lo), abs(hi)) or (lo < 0) != (hi < 0) for _, lo, hi, _ in spans]
        steps = [1.0 if w else (hi - lo) / buckets for w, (_, lo, hi, _) in zip(wide, spans, strict=True)]
        x, span = F.col("x"), F.col("span")
        placed = slots(df, starts).where("slot > 0")
        placed = placed.select("x", (F.element_at(F.lit(first), F.col("i") + 1) + F.col("slot")).alias("span"))
        size = F.abs(x)
        power = F.when(size == math.inf, F.lit(1100.0)).when(size > 0, F.floor(F.log2(size)).cast("double"))
        power = F.signum(x) * (F.coalesce(power, F.lit(0.0)) + 1200)  # zero gives 0; the smallest number has power -1074
        part = F.floor(F.try_divide(x - F.element_at(F.lit(lows), span), F.element_at(F.lit(steps), span)))
        part = F.coalesce(F.least(part, F.lit(buckets - 1)).cast("double"), x)
        bucket = F.when(F.element_at(F.lit(wide), span), power).otherwise(part)
        counted = (
            placed.where(x <= F.element_at(F.lit(highs), span))
            .groupBy((span - 1).alias("span"), (x if few else bucket).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
            .toPandas()
        )
        tables = {span: t.sort_values("bucket") for span, t in counted.groupby("span")}
        index = {(c, lo, hi): i for i, (c, lo, hi, _) in enumerate(spans)}
        for (c, r), (lo, hi, _, below) in list(search.items()):
            t = tables[index[c, lo, hi]]
            upto = below + t["n"].to_numpy().cumsum()
            at = int(upto.searchsorted(r, side="right"))
            row = t.iloc[at]
            search[c, r] = (float(row["lo"]), float(row["hi"]), int(row["n"]), int(upto[at] - row["n"]))


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], ends: dict[str, tuple[float, float, int]] | None = None
) -> dict[str, list[float] | None]:
    """Exact quantiles with linear interpolation between neighbours; ``None`` for a column without values."""
    ends = ends or extremes(df, columns)
    at = {c: [(ends[c][2] - 1) * p for p in probs] for c in columns if ends[c][2]}
    ranks = {c: [f(x) for x in xs for f in (math.floor, math.ceil)] for c, xs in at.items()}
    values = values_at_ranks(df, ranks, ends)
    out: dict[str, list[float] | None] = dict.fromkeys(columns)
    for c, xs in at.items():
        around = [(values[c][math.floor(x)], values[c][math.ceil(x)], x - math.floor(x)) for x in xs]
        out[c] = [low + (high - low) * part for low, high, part in around]
    return out


def lookup(
    df: DataFrame, table: DataFrame, key: str, value: str, weight: str, rows: int | None = None
) -> DataFrame:
    """Left-join ``table(key, value, weight)`` on ``key``. ``table`` must be materialised: its rows are counted here,
    unless the caller knows them.

    ``weight`` is the number of rows behind each key when the table was fitted; it picks the keys served by broadcast
    when the whole table is too large for one.
    """
    if (table.count() if rows is None else rows) <= BROADCAST_ROWS:
        return df.join(F.broadcast(table.select(key, value)), key, "left")
    heavy = table.orderBy(F.desc(weight), key).limit(HEAVY_KEYS).select(key, F.col(value).alias("_heavy"))
    tagged = df.join(F.broadcast(heavy.withColumn("_is_heavy", F.lit(True))), key, "left")
    # rows already served are spread at random and match nothing below
    spread = F.when(F.col("_is_heavy"), F.pmod(F.xxhash64(*df.columns), F.lit(4096)) + 1).otherwise(F.lit(0))
    rest = table.select(key, value).withColumn("_spread", F.lit(0).cast("long"))
    joined = tagged.withColumn("_spread", spread.cast("long")).join(rest, [key, "_spread"], "left")
    return joined.withColumn(value, F.coalesce("_heavy", value)).select(*df.columns, value)
