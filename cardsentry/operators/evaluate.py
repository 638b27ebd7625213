"""Curves, metrics and costs of scores against labels, for any number of models side by side.

All of it starts from one table: rows counted per distinct score, with running totals from the highest score down.
The running totals are distributed (``running_totals``), because a continuous score has about as many distinct values as
rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.functions.scalar import ratio_or_zero
from cardsentry.operators.ordering import running_totals
from cardsentry.schema import LABEL

# The cost of a false alarm and of a miss, and the 91 thresholds 0.05, 0.06, ... 0.95 with the
# floating-point values that counting up from 0.05 gives.
COST_FALSE_POSITIVE, COST_FALSE_NEGATIVE = 50.0, 500.0
FIRST_THRESHOLD, THRESHOLDS = 0.05, 91
THRESHOLD_STEP = (0.05 + 0.01) - 0.05
DEFAULT_CUT = 0.5
F1_EPSILON = 1e-12


def long_scores(df: DataFrame, models: dict[str, str], label: str = LABEL) -> DataFrame:
    """(model, score, label) rows from the score columns ``{model name: column}``."""
    cells = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score")) for m, c in models.items()]
    )
    return df.select(F.col(label).cast("int").alias("label"), F.explode(cells).alias("c")).select("c.*", "label")


def curve(long: DataFrame, by: list[str]) -> DataFrame:
    """Per group and distinct score, descending: rows and positives at the score (n, pos), at or above it (k, tp), and
    of the whole group (total, positives)."""
    return curve_of(long.groupBy(*by, "score").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")), by)


def curve_of(counts: DataFrame, by: list[str]) -> DataFrame:
    """The curve of rows that are counted already, one row a group and score."""
    return running_totals(
        counts, by, [F.col("score").desc()], sums={"k": "n", "tp": "pos"}, group_sums={"total": "n", "positives": "pos"}
    )


def pr_curve(points: DataFrame) -> DataFrame:
    return points.withColumns(
        {"precision": F.col("tp") / F.col("k"), "recall": ratio_or_zero(F.col("tp"), F.col("positives"))}
    )


def roc_curve(points: DataFrame) -> DataFrame:
    fp, negatives = F.col("k") - F.col("tp"), F.col("total") - F.col("positives")
    return points.withColumns({"fpr": ratio_or_zero(fp, negatives), "tpr": ratio_or_zero(F.col("tp"), F.col("positives"))})


def _average_precision() -> Column:
    """Step-wise area under the precision-recall curve."""
    return ratio_or_zero(F.sum(F.col("pos") * F.col("tp") / F.col("k")), F.max("positives"))


def _roc_auc() -> Column:
    """Trapezoids: each step adds its negatives times the mean of the positives before and after."""
    area = F.sum((F.col("n") - F.col("pos")) * (F.col("tp") - F.col("pos") / 2))
    return ratio_or_zero(area, F.max("positives") * (F.max("total") - F.max("positives")))


def _best_f1() -> Column:
    """(f1, -threshold, k, tp) of the highest F1, lowest threshold on ties."""
    precision, recall = F.col("tp") / F.col("k"), ratio_or_zero(F.col("tp"), F.col("positives"))
    f1 = 2 * precision * recall / (precision + recall + F1_EPSILON)
    return F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("minus"), "k", "tp"))


def average_precision(points: DataFrame, by: list[str]) -> DataFrame:
    return points.groupBy(*by).agg(_average_precision().alias("average_precision"))


def roc_auc(points: DataFrame, by: list[str]) -> DataFrame:
    return points.groupBy(*by).agg(_roc_auc().alias("roc_auc"))


def best_f1(points: DataFrame, by: list[str]) -> DataFrame:
    best = points.groupBy(*by).agg(_best_f1().alias("b"))
    return best.select(*by, (-F.col("b.minus")).alias("threshold"), F.col("b.f1").alias("f1"))


def confusion(predicted: Column, label: Column) -> dict[str, Column]:
    return {
        "tn": F.count_if(~predicted & (label == 0)),
        "fp": F.count_if(predicted & (label == 0)),
        "fn": F.count_if(~predicted & (label == 1)),
        "tp": F.count_if(predicted & (label == 1)),
    }


def confusion_at_threshold(long: DataFrame, threshold: float) -> DataFrame:
    cells = confusion(F.col("score") >= F.lit(float(threshold)), F.col("label"))
    return long.groupBy("model").agg(*[v.alias(k) for k, v in cells.items()])


def precision_recall_f1(cells: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.withColumns(
        {
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
            "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        }
    )


def model_metrics(long: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row per model: areas, the confusion cells and rates at ``threshold`` (default: that of the best F1)."""
    if threshold is None:
        at, k, tp = -F.col("b.minus"), F.col("b.k"), F.col("b.tp")
        best = _best_f1()
    else:
        at, k, tp = F.lit(float(threshold)), F.col("b.k"), F.col("b.tp")
        hit = F.col("score") >= at
        best = F.struct(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("k"), F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"))
    summary = (
        curve(long, ["model"])
        .groupBy("model")
        .agg(
            _average_precision().alias("pr_auc"),
            _roc_auc().alias("roc_auc"),
            best.alias("b"),
            F.max("total").alias("total"),
            F.max("positives").alias("positives"),
        )
    )
    cells = summary.select(
        "model",
        "pr_auc",
        "roc_auc",
        at.alias("optimal_threshold"),
        (F.col("total") - F.col("positives") - (k - tp)).alias("tn"),
        (k - tp).alias("fp"),
        (F.col("positives") - tp).alias("fn"),
        tp.alias("tp"),
    )
    return precision_recall_f1(cells)


def thresholds_reached(score: Column) -> Column:
    """How many of the 91 thresholds are at or below the score; the division is corrected by exact comparison."""
    step = F.lit(THRESHOLD_STEP)

    def threshold(i: Column) -> Column:
        return F.lit(FIRST_THRESHOLD) + i * step

    guess = F.floor((score - F.lit(FIRST_THRESHOLD)) / step).cast("double")
    guess = F.greatest(F.lit(-1.0), F.least(F.lit(float(THRESHOLDS - 1)), guess))
    exact = (
        F.when((guess >= 0) & (threshold(guess) > score), guess - 1)
        .when((guess < THRESHOLDS - 1) & (threshold(guess + 1) <= score), guess + 1)
        .otherwise(guess)
    )
    return (exact + 1).cast("int")


def _reached(long: DataFrame) -> DataFrame:
    """(model, reached, counts): rows by the number of thresholds they reach, at most 92 per model."""
    label, default = F.col("label"), F.col("score") >= F.lit(DEFAULT_CUT)
    return (
        long.withColumn("reached", thresholds_reached(F.col("score")))
        .groupBy("model", "reached")
        .agg(
            F.count_if(label == 0).alias("neg"),
            F.count_if(label == 1).alias("pos"),
            F.count_if((label == 0) & default).alias("default_fp"),
            F.count_if((label == 1) & ~default).alias("default_fn"),
        )
    )


def _cost(fp: str, fn: str, cost_fp: float, cost_fn: float) -> Column:
    return F.col(fp) * F.lit(float(cost_fp)) + F.col(fn) * F.lit(float(cost_fn))


def cost_curve(
    long: DataFrame, cost_fp: float = COST_FALSE_POSITIVE, cost_fn: float = COST_FALSE_NEGATIVE
) -> DataFrame:
    """(model, idx, threshold, fp, fn, cost) for the 91 thresholds: one aggregate to at most 92 rows per model, then
    sums over those."""
    return _costs(_reached(long), cost_fp, cost_fn)


def _costs(reached: DataFrame, cost_fp: float, cost_fn: float) -> DataFrame:
    entries = F.map_from_entries(F.collect_list(F.struct("reached", F.struct("neg", "pos"))))
    slots = F.explode(F.sequence(F.lit(0), F.lit(THRESHOLDS))).alias("reached")
    full = reached.groupBy("model").agg(entries.alias("counts")).select("model", "counts", slots)
    found = F.try_element_at("counts", F.col("reached"))
    full = full.withColumns({c: F.coalesce(found[c], F.lit(0)) for c in ("neg", "pos")})
    ahead = Window.partitionBy("model").orderBy("reached").rowsBetween(1, Window.unboundedFollowing)
    behind = Window.partitionBy("model").orderBy("reached").rowsBetween(Window.unboundedPreceding, 0)
    sums = full.select(
        "model",
        F.col("reached").alias("idx"),
        (F.lit(FIRST_THRESHOLD) + F.col("reached") * F.lit(THRESHOLD_STEP)).alias("threshold"),
        F.sum("neg").over(ahead).alias("fp"),
        F.sum("pos").over(behind).alias("fn"),
    ).where(F.col("idx") < THRESHOLDS)
    return sums.withColumn("cost", _cost("fp", "fn", cost_fp, cost_fn))


def best_cost(costs: DataFrame) -> DataFrame:
    """Per model the first threshold of lowest cost."""
    best = costs.groupBy("model").agg(F.min(F.struct("cost", "idx", "threshold")).alias("b"))
    return best.select("model", F.col("b.threshold").alias("threshold"), F.col("b.cost").alias("cost"))


def cost_analysis(
    long: DataFrame, cost_fp: float = COST_FALSE_POSITIVE, cost_fn: float = COST_FALSE_NEGATIVE
) -> DataFrame:
    """Per model the cheapest threshold and its cost, beside the cost at 0.5; the scores are read once."""
    reached = _reached(long)
    best = best_cost(_costs(reached, cost_fp, cost_fn))
    default = reached.groupBy("model").agg(F.sum("default_fp").alias("fp"), F.sum("default_fn").alias("fn"))
    return best.join(default, "model").select(
        "model",
        F.col("threshold").alias("cost_optimal_threshold"),
        F.col("cost").alias("cost_at_optimal"),
        _cost("fp", "fn", cost_fp, cost_fn).alias("cost_at_default"),
        F.lit(float(cost_fp)).alias("cost_fp"),
        F.lit(float(cost_fn)).alias("cost_fn"),
    )


def random_baseline(df: DataFrame, label: str = LABEL) -> DataFrame:
    """The precision of a random scorer: the share of positives."""
    return df.agg(F.coalesce(F.avg((F.col(label).cast("int") == 1).cast("int")), F.lit(0.0)).alias("baseline"))


def score_stats_by_class(long: DataFrame) -> DataFrame:
    return long.groupBy("model", "label").agg(
        F.avg("score").alias("mean_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score")
    )


def full_evaluation(df: DataFrame, models: dict[str, str], label: str = LABEL) -> DataFrame:
    """Metrics and costs of all models as (section, model, metric, value) rows."""
    long = long_scores(df, models, label)
    metrics, costs = model_metrics(long), cost_analysis(long)

    def rows(section: str, wide: DataFrame) -> DataFrame:
        names = [c for c in wide.columns if c != "model"]
        cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])
        return wide.select(F.lit(section).alias("section"), "model", F.explode(cells).alias("c")).select(
            "section", "model", "c.*"
        )

    return rows("metrics", metrics).unionByName(rows("costs", costs))
