"""Blending of the three scores, risk tiers, and the search for weights and thresholds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.functions.scalar import ratio_or_zero
from cardsentry.operators import evaluate as E
from cardsentry.schema import AMOUNT, LABEL, ROW_ID, TIME
from cardsentry.session import small_table

SCORES = ["iso_score", "ae_score", "xgb_score"]
# Tier limits, alert threshold before fitting, weight grid step.
LOW_BELOW, HIGH_FROM = 0.3, 0.7
DEFAULT_THRESHOLD = 0.5
GRID_STEP = 0.1
FEW_POSITIVES = 100_000
PART_ROWS, BUNCH_ROWS, CUT_ROWS = 500_000, 65_536, 50_000


def normalised(weights: tuple[float, float, float]) -> tuple[float, float, float]:
    total = sum(weights)
    return tuple(w / total for w in weights) if abs(total - 1.0) > 1e-6 else tuple(weights)


def combine_scores(weights: tuple[float, float, float], columns: list[str] = SCORES) -> Column:
    iso, ae, xgb = (F.coalesce(F.col(c), F.lit(0.0)) for c in columns)
    w_iso, w_ae, w_xgb = (F.lit(float(w)) for w in normalised(weights))
    return w_iso * iso + w_ae * ae + w_xgb * xgb


def risk_tier(score: Column, low: float = LOW_BELOW, high: float = HIGH_FROM) -> Column:
    return F.when(score < low, "LOW").when(score < high, "MEDIUM").otherwise("HIGH")


def weight_grid() -> list[tuple[int, float, float, float]]:
    """(index, iso, ae, xgb): all weights in tenths that sum to 1, the first weight outermost."""
    cells = [(i * GRID_STEP, j * GRID_STEP) for i in range(11) for j in range(11 - i)]
    return [(k, a, b, 1.0 - a - b) for k, (a, b) in enumerate(cells)]


def weight_search(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(idx, w_iso, w_ae, w_xgb, average_precision) of all 66 grid cells.

    Average precision only asks, for each positive row, how many rows score at least as high. While the positives are
    few, their blended scores are therefore sent to all tasks and the rows are merely counted between them. With many
    positives the scores of every cell are sorted in parts.
    """
    df = df.na.fill(0.0, SCORES)
    positives = df.where(F.col(label).cast("int") == 1).select(*SCORES).limit(FEW_POSITIVES + 1).toPandas()
    if 0 < len(positives) <= FEW_POSITIVES:
        found = _precision_by_counting(df, positives, label)
    else:
        found = _precision_by_parts(df, label)
    weights = small_table(df.sparkSession, weight_grid(), "idx int, w_iso double, w_ae double, w_xgb double")
    return weights.join(found, "idx")


def _precision_by_counting(df: DataFrame, positives: pd.DataFrame, label: str) -> DataFrame:
    """One pass without a shuffle of rows: every task returns at most one count per cell and positive score."""
    known = positives.to_numpy(dtype=float)
    levels = [np.unique(a * known[:, 0] + b * known[:, 1] + c * known[:, 2]) for _, a, b, c in weight_grid()]
    shared = df.sparkSession.sparkContext.broadcast(levels)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = list(zip(weight_grid(), shared.value, strict=True))
        rows = [np.zeros(len(v) + 1, dtype=np.int64) for _, v in cells]
        hits = [np.zeros(len(v) + 1, dtype=np.int64) for _, v in cells]
        for batch in batches:
            iso, ae, xgb, y = (batch[c].to_numpy(dtype=float) for c in (*SCORES, "label"))
            for (k, a, b, c), v in cells:
                # how many of the positive scores the row reaches
                slot = np.searchsorted(v, a * iso + b * ae + c * xgb, side="right")
                rows[k] += np.bincount(slot, minlength=len(v) + 1)
                hits[k] += np.bincount(slot[y == 1], minlength=len(v) + 1)
        for (k, *_), _ in cells:
            at = np.flatnonzero(rows[k])
            yield pd.DataFrame({"idx": k, "reached": at, "n": rows[k][at], "pos": hits[k][at]})

    scores = df.select(*SCORES, F.col(label).cast("int").alias("label"))
    counted = scores.mapInPandas(count, "idx int, reached long, n long, pos long")
    slots = counted.groupBy("idx", "reached").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    # at most FEW_POSITIVES + 1 rows per cell
    down = Window.partitionBy("idx").orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, 0)
    points = slots.withColumns({"k": F.sum("n").over(down), "tp": F.sum("pos").over(down)})
    totals = F.sum("pos").over(Window.partitionBy("idx"))
    return E.average_precision(points.withColumn("positives", totals), ["idx"])


def _precision_by_parts(df: DataFrame, label: str, part_rows: int = PART_ROWS) -> DataFrame:
    """The blended scores of a cell are cut into parts of about ``part_rows`` rows along the score. Parts are counted first,
    so that each knows the rows and positives above it; then the scores of a part meet in one task, sorted and counted
    before they are sent. The cuts come from a few rows, which only decides how even the parts are."""
    grid = weight_grid()
    scores = df.select(*[F.col(c).cast("double").alias(c) for c in SCORES], F.col(label).cast("int").alias("label"))
    parts = -(-scores.count() // part_rows)
    share = min(1.0, CUT_ROWS / max(parts * part_rows, 1))
    few = scores.select(*SCORES).sample(share, 42).toPandas().to_numpy(dtype=float) if parts > 1 else np.zeros((0, 3))
    inner = [i / parts for i in range(1, parts)] if len(few) else []
    cuts = [np.unique(np.quantile(a * few[:, 0] + b * few[:, 1] + c * few[:, 2], inner)) if inner else np.zeros(0) for _, a, b, c in grid]
    shared = df.sparkSession.sparkContext.broadcast(cuts)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(cell, scores, 1 for positives) of a bunch of rows."""
        held: list[np.ndarray] = []
        for last, b in marked(batches):
            y = pc.fill_null(pc.equal(b["label"], 1), False).to_numpy(zero_copy_only=False)
            held.append(np.column_stack([*(b[c].to_numpy(zero_copy_only=False) for c in SCORES), y]))
            if last or sum(map(len, held)) >= BUNCH_ROWS:
                x = np.concatenate(held)
                held = []
                iso, ae, xgb, hits = x.T
                for k, a, b_, c in grid:
                    yield k, a * iso + b_ * ae + c * xgb, hits.astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(c) + 1, np.int64) for c in shared.value]
        pos = [np.zeros(len(c) + 1, np.int64) for c in shared.value]
        for k, score, hits in cells(batches):
            at = np.searchsorted(shared.value[k], score, side="right")
            n[k] += np.bincount(at, minlength=len(n[k]))
            pos[k] += np.bincount(at[hits == 1], minlength=len(n[k]))
        for k, own in enumerate(n):
            yield pa.record_batch([pa.array(np.full(len(own), k)), pa.array(np.arange(len(own))), pa.array(own), pa.array(pos[k])], ["idx", "part", "n", "pos"])

    counted = scores.mapInArrow(count, "idx long, part long, n long, pos long").groupBy("idx", "part").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    found = counted.toPandas().sort_values(["idx", "part"], ascending=[True, False])  # one row per cell and part
    above = {c: found.groupby("idx")[c].cumsum() - found[c] for c in ("n", "pos")}
    carried = {(i, p): (n, pos) for i, p, n, pos in zip(found["idx"], found["part"], above["n"], above["pos"], strict=True)}
    before = df.sparkSession.sparkContext.broadcast(carried)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, score, hits in cells(batches):
            values, n, pos = _levels(score, np.ones(len(score), np.int64), hits)
            ends = np.concatenate([[0], np.searchsorted(values, shared.value[k], side="left"), [len(values)]])
            own = [(p, a, b) for p, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if b > a]
            columns = [[x[a:b].tobytes() for _, a, b in own] for x in (values, n.astype(np.int32), pos.astype(np.int32))]
            yield pa.record_batch(
                [pa.array(np.full(len(own), k)), pa.array([p for p, *_ in own], pa.int64()), *[pa.array(c, pa.binary()) for c in columns]],
                ["idx", "part", "score", "n", "pos"],
            )

    def merge(table: pa.Table) -> pa.Table:
        idx, part = table["idx"][0].as_py(), table["part"][0].as_py()
        joined = lambda c, kind: np.frombuffer(b"".join(table[c].to_pylist()), kind)
        _, n, pos = _levels(joined("score", float), joined("n", np.int32), joined("pos", np.int32))
        k0, tp0 = before.value[idx, part]
        k, tp = k0 + np.cumsum(n[::-1]), tp0 + np.cumsum(pos[::-1])
        return pa.table({"idx": [idx], "area": [float((pos[::-1] * tp / k).sum())], "pos": [int(pos.sum())]})

    packed = scores.mapInArrow(pack, "idx long, part long, score binary, n binary, pos binary")
    areas = packed.groupBy("idx", "part").applyInArrow(merge, "idx long, area double, pos long")
    precision = ratio_or_zero(F.sum("area"), F.sum("pos")).alias("average_precision")
    return areas.groupBy(F.col("idx").cast("int").alias("idx")).agg(precision)


def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """The batches that have rows, and which one is the last."""
    held = None
    for b in batches:
        if b.num_rows:
            if held is not None:
                yield False, held
            held = b
    if held is not None:
        yield True, held


def _levels(score: np.ndarray, n: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct scores, ascending, and the sums of n and pos at each)."""
    order = np.argsort(score, kind="stable")
    ranked = score[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return ranked[starts], *(np.add.reduceat(x[order].astype(np.int64), starts) for x in (n, pos))


def optimize_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """The first grid cell of highest average precision (compared to 12 decimals)."""
    return weight_search(df, label).orderBy(F.round("average_precision", 12).desc(), "idx").limit(1)


def optimize_threshold(df: DataFrame, score: str, method: str = "cost", label: str = LABEL, **costs) -> float:
    long = E.long_scores(df, {"score": score}, label)
    if method == "f1":
        best = E.best_f1(E.curve(long, ["model"]), ["model"]).first()
    else:
        best = E.best_cost(E.cost_curve(long, **costs)).first()
    return best["threshold"] if best else DEFAULT_THRESHOLD


@dataclass(frozen=True)
class Ensemble:
    weights: tuple[float, float, float] = (1 / 3, 1 / 3, 1 / 3)
    threshold: float = DEFAULT_THRESHOLD
    low: float = LOW_BELOW
    high: float = HIGH_FROM

    def fit(self, df: DataFrame, method: str = "cost", label: str = LABEL) -> Ensemble:
        """Weights by average precision, then the threshold by cost or F1, on a table of scores and labels."""
        best = optimize_weights(df, label).first()
        tuned = replace(self, weights=normalised((best["w_iso"], best["w_ae"], best["w_xgb"])))
        blended = df.withColumn("_blend", combine_scores(tuned.weights))
        return replace(tuned, threshold=optimize_threshold(blended, "_blend", method, label))

    def score(self, df: DataFrame) -> DataFrame:
        """Add fraud_score, risk_tier and should_alert; tier and alert look at the unrounded score."""
        have = {c: F.col(c) if c in df.columns else F.lit(0.0) for c in SCORES}
        df = df.withColumns(have).withColumn("_blend", combine_scores(self.weights))
        return df.withColumns(
            {
                "fraud_score": F.round("_blend", 4),
                "risk_tier": risk_tier(F.col("_blend"), self.low, self.high),
                "should_alert": F.col("_blend") >= F.lit(float(self.threshold)),
                **{c: F.round(c, 4) for c in SCORES},
            }
        ).drop("_blend")


def scored_record(scored: DataFrame) -> DataFrame:
    """The ten output fields of a scored transaction. ``processing_time_ms`` is kept if the input measured it."""
    spent = F.col("processing_time_ms") if "processing_time_ms" in scored.columns else F.lit(None)
    text = F.date_format(TIME, "yyyy-MM-dd HH:mm:ss")
    return scored.select(
        F.coalesce(F.col(ROW_ID).cast("string"), F.lit("")).alias("transaction_id"),
        F.coalesce(text, F.lit("")).alias("timestamp"),
        F.coalesce(F.col(AMOUNT), F.lit(0.0)).alias("amount"),
        "fraud_score",
        "risk_tier",
        *SCORES,
        "should_alert",
        F.round(spent.cast("double"), 2).alias("processing_time_ms"),
    )
