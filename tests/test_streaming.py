import random
import uuid
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardsentry.operators.scoring import scored_record
from cardsentry.operators.velocity import velocity_features
from cardsentry.plans.training import train
from cardsentry.sources.tables import transactions
from cardsentry.streaming import run, scoring
from cardsentry.streaming.alerts import rate_limit_sink
from cardsentry.streaming.velocity import VelocityProcessor, late_rows_apart, stream_velocity
from tests.test_monitoring import limited_by_hand
from tests.test_velocity import T0, edge_rows, frame, random_rows


def stream_of(spark, tmp_path, parts):
    path = str(tmp_path / f"in-{uuid.uuid4().hex}")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def collect(spark, tmp_path, stream):
    out = str(tmp_path / f"out-{uuid.uuid4().hex}")
    run.process_available(stream, str(tmp_path / f"cp-{uuid.uuid4().hex}"), run.write_batches(out))
    return run.read_batches(spark, out).drop("batch")


def end_mark(df, card="cc_num"):
    """A record without a card, a year on."""
    later = (F.max("trans_date_trans_time") + F.expr("INTERVAL 1 YEAR")).alias("trans_date_trans_time")
    last = df.agg(later)
    fields = df.schema.fields
    return last.select(*[F.col(f.name) if f.name in last.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


NAMES = ["time_since_last_txn", "rapid_fire_flag", "txn_count_1h", "txn_count_24h", "avg_amount_24h", "amount_zscore"]


def test_stream_velocity_equals_batch_in_any_order(spark, tmp_path):
    rows = edge_rows() + [(f"r{r[0]}", r[1] + 100, *r[2:]) for r in random_rows(300, 4, 8)]
    random.Random(1).shuffle(rows)
    df = frame(spark, rows)
    n = len(rows) // 4
    parts = [frame(spark, rows[i : i + n]) for i in range(0, len(rows), n)]
    stream = stream_velocity(stream_of(spark, tmp_path, [*parts, end_mark(df)]), 7.5, delay="400 days")
    got = collect(spark, tmp_path, stream)
    assert got.where("late").count() == 0 and got.count() == 0  # all of them wait: the mark is only a year ahead
    stream = stream_velocity(stream_of(spark, tmp_path, [*parts, end_mark(df)]), 7.5, delay="100 days")
    got = collect(spark, tmp_path, stream)
    assert got.where("late").count() == 0
    want = {r["trans_num"]: r for r in velocity_features(df, 7.5).collect()}
    for r in got.collect():
        assert [r[c] for c in NAMES] == pytest.approx([want[r["trans_num"]][c] for c in NAMES], abs=1e-6, nan_ok=True)
    assert got.count() == len(rows)


def test_rows_beyond_the_watermark_come_out_apart(spark, tmp_path):
    first = frame(spark, [("a", 1, T0 + timedelta(hours=2), 5.0)])
    # within the delay of an hour, and beyond it
    second = frame(spark, [("b", 1, T0 + timedelta(hours=1, minutes=30), 7.0), ("e", 3, T0 + timedelta(hours=9), 1.0)])
    third = frame(spark, [("c", 1, T0, 5.0), ("d", 2, T0 + timedelta(hours=9), 1.0), ("f", 1, T0 + timedelta(hours=8, minutes=30), 9.0)])
    # the watermark of a batch is told by those before it, so that of the third one releases the first rows
    between = frame(spark, [("g", 9, T0 + timedelta(hours=9), 1.0)])
    parts = [first, second, between, third, end_mark(first)]
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    stream = stream_velocity(stream_of(spark, tmp_path, parts), delay="1 hour")
    run.process_available(stream, str(tmp_path / "cp"), late_rows_apart(out, rejects))
    got = {r["trans_num"]: r for r in run.read_batches(spark, out).collect()}
    lost = run.read_batches(spark, rejects).drop("batch")
    assert lost.columns == first.columns and [r["trans_num"] for r in lost.collect()] == ["c"]
    assert set(got) == set("abdefg")
    assert (got["b"]["txn_count_24h"], got["a"]["txn_count_24h"], got["f"]["txn_count_24h"]) == (1, 2, 3)
    assert got["a"]["avg_amount_24h"] == 6.0


class Store(dict):
    """Keyed state in memory, with the calls that the processor makes."""

    def exists(self):
        return "v" in self

    def get(self):
        return self["v"]

    def update(self, v):
        self["v"] = v

    def getValue(self, k):
        return self[k]

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        self.pop(k, None)

    def containsKey(self, k):
        return k in self

    def iterator(self):
        return iter(list(self.items()))


class Handle:
    def __init__(self):
        self.stores, self.timers = {}, set()

    def getValueState(self, name, *_):
        return self.stores.setdefault(name, Store())

    getMapState = getValueState

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_a_backlog_of_one_card_goes_through_in_pieces():
    """90,000 rows of a card in one batch, shuffled: no piece is larger than asked for, and the state ends small."""
    n, step = 90_000, 2_000_000
    us = np.arange(n, dtype=np.int64) * step
    rows = pd.DataFrame({"trans_num": [f"{i:06d}" for i in range(n)], "cc_num": 7, "event_us": us, "amt": (us // step % 97) / 7.0})
    handle = Handle()
    processor = VelocityProcessor(1.0, "trans_num", piece_rows=5_000)
    processor.init(handle)
    shuffled = rows.sample(frac=1.0, random_state=3)
    parts = (shuffled.iloc[i : i + 10_000] for i in range(0, n, 10_000))
    assert list(processor.handleInputRows((7,), parts, At(0))) == []
    assert len(handle.timers) == 1
    handle.timers.clear()
    pieces = list(processor.handleExpiredTimer((7,), At(2**53), None))
    assert sum(map(len, pieces)) == n and max(map(len, pieces)) <= 5_000 + 31
    out = pd.concat(pieces, ignore_index=True)
    assert out["trans_num"].tolist() == rows["trans_num"].tolist()
    assert (out["txn_count_1h"].to_numpy() == np.minimum(np.arange(n) + 1, 1801)).all()
    assert (out["txn_count_24h"].to_numpy() == np.minimum(np.arange(n) + 1, 43201)).all()
    sums = np.concatenate([[0.0], np.cumsum(rows["amt"])])
    first = np.maximum(np.arange(n) - 43_200, 0)
    mean = (sums[1:] - sums[first]) / (np.arange(n) + 1 - first)
    assert np.abs(out["avg_amount_24h"].to_numpy() - mean).max() < 1e-6
    assert not handle.stores["waiting"] and not handle.stores["pieces"] and not handle.timers
    assert sum(len(v[0]) for v in handle.stores["rows"].values()) <= 43_200 + 2 * 30 + 1


def test_a_missing_amount_leaves_the_window():
    day = 86_400_000_000
    for few in (2_000, 0):
        processor = VelocityProcessor(1.0, "trans_num", piece_rows=1, few_rows=few)
        processor.init(Handle())
        us = np.array([0, day // 2, 3 * day])
        rows = pd.DataFrame({"trans_num": list("abc"), "cc_num": 7, "event_us": us, "amt": [np.nan, 4.0, 6.0]})
        out = []
        for i in range(3):
            assert list(processor.handleInputRows((7,), iter([rows.iloc[i : i + 1]]), At(0))) == []
            out += processor.handleExpiredTimer((7,), At(int(us[i]) // 1000 + 60_000), None)
        got = pd.concat(out)
        assert got["txn_count_24h"].tolist() == [1, 2, 1]
        assert got["avg_amount_24h"].isna().tolist() == [True, True, False] and got["avg_amount_24h"].iloc[2] == 6.0


class Counted(Store):
    calls = 0

    def __getattribute__(self, name):
        if name in ("exists", "get", "update", "getValue", "updateValue", "removeKey", "containsKey", "iterator", "keys"):
            Counted.calls += 1
        return super().__getattribute__(name)


def test_a_card_of_few_rows_asks_the_state_a_few_times(monkeypatch):
    """Each call goes to the state store and back, so there is one value per card, not several per row; other ways of
    keeping the rows give the same features."""
    n, step = 1_500, 97_000_000
    us = np.arange(n, dtype=np.int64) * step
    rows = pd.DataFrame({"trans_num": [f"{i:06d}" for i in range(n)], "cc_num": 7, "event_us": us, "amt": (us // step % 89) / 3.0})
    found = []
    for few, piece in ((2_000, 20_000), (300, 20_000), (0, 400)):
        handle = Handle()
        monkeypatch.setattr(handle, "getMapState", handle.getValueState)
        handle.stores = {name: Counted() for name in ("card", "minutes", "rows", "waiting", "pieces")}
        processor = VelocityProcessor(1.0, "trans_num", piece_rows=piece, few_rows=few)
        processor.init(handle)
        Counted.calls, out = 0, []
        for low in range(0, n, 500):
            part = rows.iloc[low : low + 500].sample(frac=1.0, random_state=low)
            assert list(processor.handleInputRows((7,), iter([part]), At(0))) == []
            for to in (low + 250, low + 500):
                out += processor.handleExpiredTimer((7,), At((to * step // 60_000_000) * 60_000), None)
        out += processor.handleExpiredTimer((7,), At(2**53), None)
        found.append(pd.concat(out, ignore_index=True))
        if few == 2_000:
            assert Counted.calls < 60
    assert found[0]["trans_num"].tolist() == rows["trans_num"].tolist()
    for other in found[1:]:
        for c in ("trans_num", "time_since_last_txn", "rapid_fire_flag", "txn_count_1h", "txn_count_24h", "avg_amount_24h", "amount_zscore"):
            if c == "trans_num":
                assert other[c].tolist() == found[0][c].tolist()
            else:
                assert np.allclose(other[c], found[0][c], equal_nan=True, atol=1e-9), c


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    df = transactions(spark, sf_dir)
    return df, train(df, forest_options={"trees": 20}, boosted_options={"rounds": 3}, network=False)[0]


def by_id(df):
    return {r["transaction_id"]: r for r in df.drop("processing_time_ms").collect()}


@pytest.mark.parametrize("velocity", ["stateful", "stateless"])
def test_scored_stream_equals_batch(spark, tmp_path, trained, velocity):
    df, scorer = trained
    noon = F.lit("2024-01-15").cast("timestamp")
    parts = [df.where(F.col("trans_date_trans_time") < noon), df.where(F.col("trans_date_trans_time") >= noon)]
    unfit = parts[0].limit(3).withColumn("amt", F.lit(None).cast("double")).withColumn("trans_num", F.concat(F.lit("x"), "trans_num"))
    stream = stream_of(spark, tmp_path, [parts[0].unionByName(unfit), parts[1], end_mark(df)])
    got = by_id(collect(spark, tmp_path, scoring.stream_score(stream, scorer, velocity)))
    want = by_id(scored_record(scorer.score(df, velocity)))
    assert set(got) == set(want)
    for k, w in want.items():
        assert got[k]["fraud_score"] == pytest.approx(w["fraud_score"], abs=2e-4), k
        assert got[k]["timestamp"] == w["timestamp"] and got[k]["amount"] == w["amount"]


def test_late_and_unfit_records_are_not_lost(spark, tmp_path, trained):
    df, scorer = trained
    noon = F.lit("2024-01-15").cast("timestamp")
    early, late = df.where(F.col("trans_date_trans_time") < noon), df.where(F.col("trans_date_trans_time") >= noon)
    stream = stream_of(spark, tmp_path, [late, end_mark(late).limit(1), early, end_mark(end_mark(late))])
    got = by_id(collect(spark, tmp_path, scoring.stream_score(stream, scorer)))
    alone = by_id(scored_record(scorer.score(early, "stateless")))
    assert len(got) == df.count()
    known = {r[0] for r in late.select("cc_num").distinct().collect()}
    for r in early.where(F.col("cc_num").isin(known)).select("trans_num").collect():
        assert got[r[0]]["fraud_score"] == pytest.approx(alone[r[0]]["fraud_score"], abs=2e-4)
    unfit = early.limit(3).withColumn("amt", F.lit(None).cast("double"))
    found = collect(spark, tmp_path, scoring.rejected(stream_of(spark, tmp_path, [late.unionByName(unfit)]))).collect()
    assert [r["missing_fields"] for r in found] == ["amt"] * 3


def test_rate_limit_continues_over_batches_and_repeats(spark, tmp_path):
    rng = random.Random(9)
    rows, us = [], 0
    for i in range(600):
        us += rng.randrange(0, 9_000_000)
        rows.append((rng.choice("ab"), us, f"r{i:04d}"))
    schema = "channel string, us long, id string"
    sent, state = str(tmp_path / "sent"), str(tmp_path / "state")
    sink = rate_limit_sink(sent, state, F.col("us"), "id", channel=F.col("channel"))
    for b in (0, 1, 1, 2):  # the second batch is delivered twice
        sink(spark.createDataFrame(rows[b * 200 : (b + 1) * 200], schema), b)
    got = {r["id"] for r in run.read_batches(spark, sent).collect()}
    assert got == limited_by_hand(rows, 10, 60_000_000)


def test_a_repeated_batch_replaces_its_output(spark, tmp_path, trained):
    df, scorer = trained
    batch = scored_record(scorer.score(df, "stateless"))
    sink = scoring.scored_and_alerts(*(str(tmp_path / n) for n in ("scored", "alerts", "log")))
    sink(batch, 0)
    sink(batch, 0)
    assert spark.read.json(str(tmp_path / "scored")).count() == df.count()
    assert spark.read.json(str(tmp_path / "log")).count() == df.count()


def test_scored_micro_batches_equal_the_scored_stream(spark, tmp_path, trained):
    """Rows that come in time order, part by part, compressed, and are scored as tables, with a forest of any size."""
    from cardsentry.plans.catalog_streaming import _in_time
    from cardsentry.sources import files

    df, scorer = trained
    parts = _in_time(df, 400)
    assert len(parts) == 3 and sum(p.count() for p in parts) == df.count()
    ends = [p.agg(F.min("trans_date_trans_time"), F.max("trans_date_trans_time")).first() for p in parts]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))
    timeless = df.limit(2).withColumn("trans_date_trans_time", F.lit(None).cast("timestamp"))
    assert sum(p.count() for p in _in_time(df.unionByName(timeless), 400)) == df.count() + 2
    stream = stream_of(spark, tmp_path, [*parts, end_mark(df)])
    got = by_id(collect(spark, tmp_path, scoring.stream_score(stream, scorer)))
    out = str(tmp_path / "tables")
    sink = scoring.scored_batches(scorer, run.write_batches(out))
    run.process_available(scoring.placed(stream, scorer), str(tmp_path / "placed"), sink)
    assert by_id(run.read_batches(spark, out).drop("batch")) == got
    files.write_jsonl(df.select("trans_num"), str(tmp_path / "lines"), compression="gzip")
    assert all(f.name.endswith(".gz") for f in (tmp_path / "lines").glob("part-*"))
    assert spark.read.json(str(tmp_path / "lines")).count() == df.count()
