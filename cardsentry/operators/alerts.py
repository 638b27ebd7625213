"""High-risk and drift alerts: selection, rate limit, texts, payloads, history."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.session import materialise

# Fixed values, also the texts and field names of the messages below: an alert needs a score above the limit; at most ten are sent in any minute; the last hundred are kept.
ALERT_ABOVE = 0.7
MAX_PER_WINDOW, WINDOW_SECONDS = 10, 60
HISTORY = 100
PART_ROWS = 200_000
PAYLOAD_FIELDS = ["transaction_id", "amount", "amt", "fraud_score", "iso_score", "ae_score", "risk_tier", "timestamp"]


def high_risk_alerts(scored: DataFrame, above: float = ALERT_ABOVE) -> DataFrame:
    return scored.where(F.col("fraud_score") > F.lit(float(above)))


def admit(times: np.ndarray, sent: list[int], limit: int, window: int) -> list[int]:
    """Positions of the sorted ``times`` that are sent, given the last sent times (extended in place).

    While the window is full, everything before the moment its oldest entry expires is skipped by one binary search.
    """
    out, i = [], 0
    while i < len(times):
        free_from = sent[-limit] + window if len(sent) >= limit else None
        if free_from is not None and times[i] < free_from:
            i = int(np.searchsorted(times, free_from, side="left"))
            continue
        out.append(i)
        sent.append(int(times[i]))
        del sent[:-limit]
        i += 1
    return out


def rate_limited_alerts(
    alerts: DataFrame,
    us: Column,
    row_id: str,
    *,
    channel: Column | None = None,
    limit: int = MAX_PER_WINDOW,
    seconds: float = WINDOW_SECONDS,
    before: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """The alerts that are sent: one goes out if fewer than ``limit`` were *sent* in the window before it.
    ``before(channel, times)`` holds the last sent times of channels that were active earlier.

    The rule is sequential along time, but a pause of a window forgets everything before it. A channel is therefore cut
    where a whole window of the clock has no alert. The segments between are range-partitioned along channel and time into
    ``tasks`` parts (default: one for every ``PART_ROWS`` counted alerts, at most the session's shuffle partitions), so a
    segment of any length goes over as many tasks as its rows need. What a part hands on to the next one is the last ``limit`` sent times of the segment that runs through the
    cut: at first all parts run side by side as if nothing came in, then those again whose real input is another than they
    had, until all have had their own. Inputs that differ lead to the same times again as soon as both have room, so this
    mostly takes two or three rounds; a channel that is full all along takes one a part, in which only binary searches over
    the times of the parts behind are done.

    A null channel is a channel. Alerts without a time come first, at one moment.
    """
    window = int(seconds * 1_000_000)
    never = F.lit(-(1 << 60))
    name = F.lit("") if channel is None else channel
    known = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    columns = alerts.columns
    row = F.struct(*columns)
    new = alerts.select(
        known(name).alias("channel"),
        F.coalesce(us, never).alias("us"),
        F.lit(False).alias("sent"),
        F.col(row_id).cast("string").alias("id"),
        row.alias("row"),
    )
    if before is not None:
        old = before.select(known(F.col("channel")).alias("channel"), F.explode("times").alias("us"))
        new = new.unionByName(old.withColumn("sent", F.lit(True)), allowMissingColumns=True)
    new = materialise(new)  # read for the slots, the count and the parts; what makes the alerts runs once
    slot = F.floor(F.col("us") / window)
    slots = new.select("channel", slot.alias("slot")).distinct()
    along = Window.partitionBy("channel").orderBy("slot")
    segments = slots.withColumn("segment", F.col("slot") - F.row_number().over(along))
    cut = new.withColumn("slot", slot).join(segments, ["channel", "slot"])
    most = int(alerts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = tasks or min(most, max(1, -(-new.count() // PART_ROWS)))
    order = ["channel", "segment", F.desc("sent"), "us", "id"]
    # the number of a part is its partition's, so it is frozen before it is used
    parts = cut.repartitionByRange(n, *order).sortWithinPartitions(*order)
    parts = materialise(parts.select(F.spark_partition_id().alias("part"), "channel", "segment", "sent", "us", "row"))

    def runs(batches: Iterator[pa.RecordBatch], inputs: dict[int, list[int]], each: Callable) -> Iterator:
        """Go through the rows of a part; ``each(batch, positions sent)`` makes what is yielded. Ends with a tuple
        (part, first key, last key, last sent times)."""
        key, first, times, part = None, None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch["part"][0].as_py()
            names, segment = batch["channel"], batch["segment"].to_numpy()
            codes = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            ends = (np.flatnonzero((np.diff(codes) != 0) | (np.diff(segment) != 0)) + 1).tolist()
            at, sent = batch["us"].to_numpy(), batch["sent"].to_numpy(zero_copy_only=False)
            picked = [np.zeros(0, np.int64)]
            for low, high in zip([0, *ends], [*ends, len(at)], strict=True):
                own = (names[low].as_py(), int(segment[low]))
                if own != key:
                    times = list(inputs.get(part, [])) if first is None else []
                    key, first = own, first or own
                times.extend(at[low:high][sent[low:high]].tolist())
                del times[:-limit]
                fresh = low + np.flatnonzero(~sent[low:high])
                picked.append(fresh[admit(at[fresh], times, limit, window)])
            yield from each(batch, np.concatenate(picked))
        if part is not None:
            yield part, first, key, times

    def handed_on(inputs: dict[int, list[int]], rows: DataFrame) -> list:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, first, last, times in runs(batches, inputs, lambda *_: ()):
                ends = [repr(first), repr(last)]
                yield pa.record_batch([[part], [ends[0]], [ends[1]], pa.array([times], pa.list_(pa.int64()))], ["part", "first", "last", "times"])

        plain = rows.select("part", "channel", "segment", "sent", "us")
        return plain.mapInArrow(run, "part long, first string, last string, times array<long>").collect()

    inputs: dict[int, list[int]] = {}
    ends = {r["part"]: r for r in handed_on(inputs, parts)}  # one row a task
    while True:
        wanted, before_it = {}, None
        for p in sorted(ends):
            if before_it is not None and ends[before_it]["last"] == ends[p]["first"]:
                wanted[p] = list(ends[before_it]["times"])
            before_it = p
        again = [p for p in ends if wanted.get(p, []) != inputs.get(p, [])]
        inputs = wanted
        if not again:
            break
        ends |= {r["part"]: r for r in handed_on(inputs, parts.where(F.col("part").isin(again)))}

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent_rows(batch: pa.RecordBatch, picked: np.ndarray) -> list[pa.RecordBatch]:
            return [pa.RecordBatch.from_arrays(batch["row"].take(pa.array(picked)).flatten(), names=columns)]

        for out in runs(batches, inputs, sent_rows):
            if isinstance(out, pa.RecordBatch):
                yield out

    return parts.mapInArrow(keep, alerts.schema)


def _number(name: str, columns: list[str]) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in columns else F.lit(0.0)


def alert_text(scored: DataFrame) -> DataFrame:
    """Add ``text``: the readable alert, without colours."""
    have = scored.columns
    amount = F.coalesce(
        *[F.nullif(F.col(c).cast("double"), F.lit(0.0)) for c in ("amount", "amt") if c in have], F.lit(0.0)
    )
    text = F.concat_ws(
        "\n",
        F.lit("--- HIGH-RISK TRANSACTION ALERT ---"),
        F.format_string("  transaction_id: %s", F.coalesce("transaction_id", F.lit(""))),
        F.format_string("  amount: %.2f", amount),
        F.format_string("  fraud_score: %.4f", _number("fraud_score", have)),
        F.format_string("  iso_score: %.4f  ae_score: %.4f", _number("iso_score", have), _number("ae_score", have)),
        F.format_string("  risk_tier: %s", F.coalesce("risk_tier", F.lit("HIGH"))),
        F.format_string("  timestamp: %s", F.col("timestamp")),
    )
    return scored.withColumn("text", text)


def alert_payload(scored: DataFrame) -> DataFrame:
    """Add ``payload``: the JSON message with the whitelisted fields that exist."""
    fields = [c for c in PAYLOAD_FIELDS if c in scored.columns]
    message = F.struct(
        F.lit("high_risk_transaction").alias("type"),
        F.coalesce("risk_tier", F.lit("HIGH")).alias("risk_tier"),
        F.col("fraud_score"),
        F.struct(*fields).alias("transaction"),
    )
    return scored.withColumn("payload", F.to_json(message, {"ignoreNullFields": "false"}))


def drift_alert(overall: DataFrame) -> DataFrame:
    """The alert row of a drift result, with text and payload, or none if the status is OK. Drift alerts are not
    rate-limited. A column ``prediction_psi``, where it exists, is reported too."""
    status = F.upper("overall_status")
    psi = F.col("prediction_psi") if "prediction_psi" in overall.columns else F.lit(None).cast("double")
    text = F.concat_ws(
        "\n",
        F.lit("--- DRIFT ALERT ---"),
        F.format_string("  overall_status: %s", status),
        F.format_string("  features_with_drift: %s", F.concat_ws(", ", "features_with_drift")),
        F.when(psi.isNotNull(), F.format_string("  prediction_drift PSI: %.4f", psi)),
    )
    message = F.struct(
        F.lit("drift").alias("type"),
        status.alias("overall_status"),
        F.col("features_with_drift"),
        F.struct(psi.alias("psi")).alias("prediction_drift"),
    )
    payload = F.to_json(message, {"ignoreNullFields": "false"})
    return overall.where(status.isin("WARNING", "CRITICAL")).withColumns({"text": text, "payload": payload})


def alert_history(sent: DataFrame, at: str, row_id: str, keep: int = HISTORY, drift: DataFrame | None = None) -> DataFrame:
    """The last ``keep`` alerts, newest first. ``drift`` has drift alerts in the same columns, which take their place among
    the transaction alerts; at equal times a column ``type``, then the id decides."""
    rows = sent if drift is None else sent.unionByName(drift)
    kind = [F.desc("type")] if "type" in rows.columns else []
    return rows.orderBy(F.desc(at), *kind, F.desc(row_id)).limit(keep)
